"""First-seen deduplication over a finished set of rows.

A row passes when its key has not passed within the last ``ttl`` milliseconds;
rows that are held back do not extend the period. Whether a row passes depends on
the row that passed before it, which is a chain per key. The chain is cut into
time ranges:

1. each (key, range) works out, for every possible time of the last pass before
   it, the time of the last pass in it (few distinct answers: chains soon meet);
2. one small table of these answers per key is followed from range to range;
3. each (key, range), now knowing where it starts, lists its passes.

A (key, range) holds at most one moment per millisecond, so its size has a bound
that does not depend on how many rows a key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, key: str, at_ms: str, tie: str, ttl_ms: int = 600_000,
               range_ms: int = 3_600_000) -> DataFrame:
    """Rows that pass, one per key and passing moment (the lowest ``tie`` of it)."""
    if range_ms < ttl_ms:
        raise ValueError("a range must be at least as long as the period")
    moments = (rows.filter(F.col(at_ms).isNotNull())
               .select(F.col(key).alias("k"), F.col(at_ms).alias("t")).distinct()
               .withColumn("r", F.floor(F.col("t") / F.lit(range_ms))))
    kind = moments.schema["k"].dataType.simpleString()

    def answers(pdf):
        import numpy as np
        import pandas as pd
        t = np.sort(pdf["t"].to_numpy())
        after = np.searchsorted(t, t + ttl_ms)
        last = np.where(after == len(t), np.arange(len(t)), np.minimum(after, len(t) - 1))
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        r = int(pdf["r"].iloc[0])
        starts = 1 + np.searchsorted(t, r * range_ms + ttl_ms - 1, side="right")
        n = min(starts, len(t))
        ends = t[last[:n]]
        keep = np.append(ends[1:] != ends[:-1], True)
        return pd.DataFrame({"k": np.full(keep.sum(), pdf["k"].iloc[0], dtype=object), "r": r,
                             "upto": t[:n][keep], "ends": ends[keep]})

    def follow(pdf):
        import numpy as np
        import pandas as pd
        opens, ranges, starts = None, [], []
        for r, steps in pdf.sort_values(["r", "upto"]).groupby("r", sort=True):
            ranges.append(r)
            starts.append(opens)
            reach = steps if opens is None else steps[steps["upto"] >= opens]
            if len(reach):
                opens = int(reach["ends"].iloc[0]) + ttl_ms
        return pd.DataFrame({"k": np.full(len(ranges), pdf["k"].iloc[0], dtype=object), "r": ranges,
                             "opens": pd.array(starts, dtype="Int64")})

    def passes(pdf):
        import numpy as np
        import pandas as pd
        t = np.sort(pdf["t"].to_numpy())
        opens = pdf["opens"].iloc[0]
        i = 0 if pd.isna(opens) else int(np.searchsorted(t, int(opens)))
        out = []
        while i < len(t):
            out.append(t[i])
            i = int(np.searchsorted(t, t[i] + ttl_ms))
        return pd.DataFrame({"k": np.full(len(out), pdf["k"].iloc[0], dtype=object), "t": np.array(out, dtype="int64")})

    steps = moments.groupBy("k", "r").applyInPandas(answers, f"k {kind}, r bigint, upto bigint, ends bigint")
    entries = steps.groupBy("k").applyInPandas(follow, f"k {kind}, r bigint, opens bigint")
    passed = (moments.join(entries, ["k", "r"]).groupBy("k", "r")
              .applyInPandas(passes, f"k {kind}, t bigint"))
    chosen = rows.groupBy(F.col(key).alias("k"), F.col(at_ms).alias("t")).agg(F.min(tie).alias("_tie"))
    return (passed.join(chosen, ["k", "t"])
            .select(F.col("k").alias(key), F.col("t").alias(at_ms), F.col("_tie").alias(tie)))
