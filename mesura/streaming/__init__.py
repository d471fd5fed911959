"""mesura.streaming"""
