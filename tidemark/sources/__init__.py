"""Readers. Each returns a lazy DataFrame; Spark prunes columns and pushes filters into them."""
