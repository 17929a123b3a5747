"""lociflow.operators"""
