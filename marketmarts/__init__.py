"""marketmarts: labour-market marts (job postings) built as Spark jobs.

Layers: sources -> staging (dedup, company dimension, skills) -> marts
-> reads/reports, plus an event-time stream.  Every step is a DataFrame
function so Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
