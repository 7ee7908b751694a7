"""Feed arrival over time.

Feeds arrive as one dated file per source per day and must be taken in the
order of the date in their names, one file per feed per run.  Structured
Streaming's file source is deliberately not used for them: it orders new
files by modification time, admits several per micro-batch, and its state
(the file log) would duplicate the watermarks the warehouse already keeps.
The catch-up loop below is the bounded equivalent: each iteration is a
complete, atomically published daily run.
"""

from cardwatch.streaming.catchup import run_until_caught_up  # noqa: F401
