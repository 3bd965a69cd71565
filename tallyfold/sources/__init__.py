"""tallyfold.sources"""
