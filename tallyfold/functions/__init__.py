"""tallyfold.functions"""
