"""mesura.operators"""
