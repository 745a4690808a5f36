"""postloom.plans"""
