"""postloom.sources"""
