"""Shelfline: consumer-goods analytics expressed as Spark DataFrame plans."""
