"""ridemart.streaming"""
