"""Column builders. Every function takes and returns ``Column`` and stays inside the JVM,
except ``similarity.jaro_winkler`` which is an Arrow-batched pandas UDF."""
