"""Regional risk analytics written as PySpark DataFrame transformations."""
