"""ratewatch: quote-stream analytics as plain Spark DataFrame transforms.

Every operator takes and returns a DataFrame and works on batch and streaming
input alike; jobs in ``ratewatch.streaming`` and ``ratewatch.cli`` put them together.
"""
