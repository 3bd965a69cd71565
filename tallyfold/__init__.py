"""tallyfold: invoice-triage analytics and corpus preparation on Spark."""
