"""medley.functions"""
