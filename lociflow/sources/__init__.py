"""lociflow.sources"""
