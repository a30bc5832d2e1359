"""Sample-history analytics on Spark: streams of measurements in, yearly reports out."""
