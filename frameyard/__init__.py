"""frameyard: Spark DataFrame operators that prepare image datasets at scale."""
