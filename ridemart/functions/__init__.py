"""ridemart.functions"""
