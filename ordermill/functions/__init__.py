"""Column expressions shared by the jobs; none of them is a UDF."""
