"""The checked workload: one Spark query per operator, with its SQL counterpart."""
