"""postloom.streaming"""
