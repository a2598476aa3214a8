"""ridemart.operators"""
