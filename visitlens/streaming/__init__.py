"""visitlens.streaming"""
