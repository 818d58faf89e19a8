"""patchlens.operators"""
