"""postloom.functions"""
