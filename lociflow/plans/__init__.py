"""lociflow.plans"""
