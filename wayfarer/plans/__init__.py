"""Query plans: the registered queries, their SQL twins and the pipeline chain."""
