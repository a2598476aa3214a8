"""ridemart.sources"""
