"""mesura.sources"""
