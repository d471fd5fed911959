"""mesura.plans"""
