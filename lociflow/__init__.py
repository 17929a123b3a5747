"""lociflow: Spark-first mining of variant and phenotype evidence from text collections."""
