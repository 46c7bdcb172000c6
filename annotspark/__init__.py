"""annotspark: genome-annotation analytics expressed as ordinary Spark DataFrame transformations."""
