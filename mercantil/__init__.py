"""mercantil: a retail warehouse and BI engine written as Spark jobs."""
