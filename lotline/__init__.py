"""Spark-first analytics over messy event feeds and a lot register."""
