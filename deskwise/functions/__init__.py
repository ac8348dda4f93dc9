"""Column functions. All of them compile to built-in expressions; there are no Python UDFs."""
