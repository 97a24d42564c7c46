"""The relations of the warehouse, one function each."""
