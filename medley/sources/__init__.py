"""medley.sources"""
