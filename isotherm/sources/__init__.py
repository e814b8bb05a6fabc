"""Readers and writers of the landing zone, the dimension, the layer tables and the logs."""
