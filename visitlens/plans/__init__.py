"""visitlens.plans"""
