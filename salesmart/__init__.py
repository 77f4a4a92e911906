"""Spark jobs that turn change events and JSON documents into sales and movie marts."""
