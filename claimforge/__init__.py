"""Daily insurance-claim batches as Spark DataFrame functions."""
