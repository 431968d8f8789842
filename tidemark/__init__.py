"""tidemark: cleaning, ordered fill, joins and monthly means as Spark DataFrame operators."""
