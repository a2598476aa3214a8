"""ridemart.plans"""
