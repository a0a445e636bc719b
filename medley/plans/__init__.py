"""medley.plans"""
