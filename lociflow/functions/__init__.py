"""lociflow.functions"""
