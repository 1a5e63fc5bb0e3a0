"""Evidence-to-claim analytics on Spark."""
