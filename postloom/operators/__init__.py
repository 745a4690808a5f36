"""postloom.operators"""
