"""visitlens.operators"""
