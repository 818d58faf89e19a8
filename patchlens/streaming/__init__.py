"""patchlens.streaming"""
