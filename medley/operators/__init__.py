"""medley.operators"""
