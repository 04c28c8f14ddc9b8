"""Stateless discover operators on a streaming DataFrame.

The reference has no streaming.  Because C01-C11 and F01-F05 are
row-local Column expressions, the same ``score_candidates`` / ``complete`` /
``gate`` run unchanged on ``readStream``: landed candidate files are scored
and gated as they arrive; keep-best (W02) stays a batch step over the
written output, since the reference's "best copy wins" is defined over the
whole run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K
from ..functions.lexicon import Lexicon
from ..operators.discover import with_dedupe_key
from ..operators.scoring import complete, gate, score_candidates


def scored_stream(spark: SparkSession, path: str, schema, lexicon: Lexicon | None = None,
                  min_score: int = K.MIN_SCORE, require_title_commodity: bool = True) -> DataFrame:
    """readStream(parquet candidates) -> F01 -> C11 -> F02-F04 -> W01 key (streaming DataFrame)."""
    src = spark.readStream.schema(schema).parquet(path)
    return with_dedupe_key(gate(score_candidates(complete(src), lexicon), min_score, require_title_commodity))


def write_scored(stream: DataFrame, out_path: str, checkpoint: str):
    """Append scored candidates as parquet; the checkpoint (a shared folder) makes it restartable."""
    return (stream.writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
