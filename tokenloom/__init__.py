"""tokenloom: language-model corpus preparation and run analysis as Spark DataFrame jobs.

Text documents become vocabularies, one ordered token stream, batch grids and fixed-length
training examples (with frequency-bin masks and capacity-limited bin slots); the losses that
come back are aggregated into perplexity / bits-per-character and used to pick checkpoints.
Every operator is a function ``DataFrame -> DataFrame`` (or a Column expression).
"""

__version__ = "0.1.0"
