"""patchlens.functions"""
