"""Spark-native analytics for spare-parts supply chains."""
