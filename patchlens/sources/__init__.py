"""patchlens.sources"""
