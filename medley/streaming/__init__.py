"""medley.streaming"""
