"""marketloom: e-commerce order analytics expressed as Spark DataFrame plans."""
