"""The daily job, the mapping of the shared tables onto station inputs, and the query registry."""
