"""Order and customer analytics as Spark jobs.

Nested cart and user documents, or flat order lines, become order facts and
customer profiles. Everything is a lazy DataFrame plan unless a function says
that it writes.
"""
