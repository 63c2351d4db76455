"""klipgrid: a Spark-first engine for time-aligned media corpora.

Tables of videos, transcripts, word timings and clips go in as DataFrames;
every operator is a function from DataFrames to a DataFrame, so Catalyst sees
whole plans.  Nothing here imports the optional ``klipgrid.llm`` subpackage.
"""

__version__ = "0.1.0"
