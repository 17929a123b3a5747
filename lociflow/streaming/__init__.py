"""lociflow.streaming"""
