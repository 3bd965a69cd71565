"""tallyfold.operators"""
