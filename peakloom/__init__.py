"""Peakloom: Spark-native analytics over labelled sparse matrices, interval sets and link tables."""
