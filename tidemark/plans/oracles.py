"""DuckDB SQL with the same result as each query, worked out another way where there is one.

Lateness here is the row-by-row definition: the largest event time over all rows that arrived
before, less the bound.
"""

from __future__ import annotations

HOUR = 3_600_000_000
LATE_BOUND = 900_000_000
WIDE_BOUND = 7_200_000_000
IDLE = 1_800_000_000
BATCH = 120 * HOUR

_MONEY = "CAST(round(value * 100) AS BIGINT)"

_ARRIVALS = f"""a AS (
    SELECT event_id, user_id, event_type, {_MONEY} AS cents, epoch_us(ts) AS t,
           epoch_us(ts) + ((event_id * 7919) % 3600) * 1000000 AS arrival
    FROM events
)"""


def _traced(bound: int) -> str:
    return f"""{_ARRIVALS}, traced AS (
    SELECT *, (t // {HOUR}) * {HOUR} AS window_start, (t // {HOUR} + 1) * {HOUR} AS window_end,
           max(t) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - {bound} AS watermark
    FROM a
), split AS (
    SELECT *, coalesce(window_end <= watermark, false) AS is_late FROM traced
)"""


_TRACED = _traced(LATE_BOUND)

# Late by what the batches before have seen, where arrivals of five days make a batch.
_BATCHED = f"""{_ARRIVALS}, met AS (
    SELECT arrival // {BATCH} AS batch, max(max(t)) OVER (
               ORDER BY arrival // {BATCH} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATE_BOUND} AS watermark
    FROM a GROUP BY 1
), split AS (
    SELECT a.*, (t // {HOUR}) * {HOUR} AS window_start,
           coalesce((t // {HOUR} + 1) * {HOUR} <= watermark, false) AS is_late
    FROM a JOIN met ON met.batch = arrival // {BATCH}
)"""

_SRC = f"SELECT event_id, user_id, event_type, {_MONEY} AS cents FROM events"
_KEYED_SUM = f"SELECT event_type, CAST(sum({_MONEY}) AS BIGINT) AS cents FROM events GROUP BY event_type"
_ROLLING = f"""
SELECT event_id, event_type,
       CAST(sum({_MONEY}) OVER (PARTITION BY event_type ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events"""
_DOUBLE = f"SELECT event_id, {_MONEY} * 2 AS doubled FROM events"
_FIRST_ARRIVED = f"""
WITH {_ARRIVALS}
SELECT event_type, (t // {HOUR}) * {HOUR} AS window_start, CAST(sum(cents) AS BIGINT) AS cents,
       arg_min(t, (arrival, event_id)) AS t
FROM a GROUP BY 1, 2"""

ORACLES: dict[str, str] = {
    "src_bounded": _SRC,
    "src_stream": _SRC,
    "src_rows_stream": _SRC,
    "map_double": _DOUBLE,
    "map_square_filter_even": """
SELECT event_id, user_id * user_id AS squared FROM events WHERE (user_id * user_id) % 2 = 0""",
    "map_udf": _DOUBLE,
    "flat_map_words": """
SELECT doc_id, CAST(unnest(range(len(w))) AS BIGINT) AS pos, unnest(w) AS word
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
    "flat_map_subevents": """
SELECT event_id, CAST(unnest(range(1, event_id % 3 + 1)) AS BIGINT) AS i FROM events""",
    "word_count": """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "key_by_colocated": """
SELECT user_id, CAST(1 AS BIGINT) AS partitions, count(*) AS n FROM events GROUP BY user_id""",
    "keyed_sum_final": _KEYED_SUM,
    "keyed_sum_update_stream": _KEYED_SUM,
    "keyed_sum_rolling": _ROLLING,
    "keyed_sum_rolling_stream": _ROLLING,
    "keyed_reduce_rolling": f"""
SELECT event_id, event_type,
       CAST(sum({_MONEY}) OVER (PARTITION BY event_type ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents,
       min(event_id) OVER (PARTITION BY event_type) AS first_event_id
FROM events""",
    "keyed_aggregate": f"""
SELECT user_id, CAST(sum({_MONEY}) AS BIGINT) AS total, count(*) AS n,
       CAST(sum({_MONEY}) // count(*) AS BIGINT) AS mean
FROM events GROUP BY user_id""",
    "tumble_arrival_sum": f"""
WITH {_ARRIVALS}
SELECT event_type, (arrival // {HOUR}) * {HOUR} AS window_start, CAST(sum(cents) AS BIGINT) AS cents
FROM a GROUP BY 1, 2""",
    "tumble_event_sum": f"""
SELECT event_type, (epoch_us(ts) // {HOUR}) * {HOUR} AS window_start, CAST(sum({_MONEY}) AS BIGINT) AS cents
FROM events GROUP BY 1, 2""",
    "tumble_event_reduce": f"""
WITH {_traced(WIDE_BOUND)}
SELECT event_type, window_start, CAST(sum(cents) AS BIGINT) AS cents, arg_min(t, (arrival, event_id)) AS t
FROM split WHERE NOT is_late GROUP BY 1, 2""",
    "tumble_udaf_reduce": _FIRST_ARRIVED,
    "tumble_udaf_combined": f"""
WITH {_ARRIVALS}
SELECT event_type, (t // {HOUR}) * {HOUR} AS window_start, CAST(sum(cents) AS BIGINT) AS cents,
       arg_min(t, (arrival, event_id)) AS t, min(cents) AS least, max(cents) AS most
FROM a GROUP BY 1, 2""",
    "tumble_count_avg": f"""
SELECT event_type, (epoch_us(ts) // {HOUR}) * {HOUR} AS window_start, count(*) AS n,
       CAST(sum({_MONEY}) // count(*) AS BIGINT) AS mean
FROM events GROUP BY 1, 2""",
    "count_window_sum": f"""
WITH numbered AS (
    SELECT user_id, {_MONEY} AS cents,
           (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS window_no
    FROM events
)
SELECT user_id, window_no, CAST(sum(cents) AS BIGINT) AS cents, count(*) = 10 AS complete
FROM numbered GROUP BY 1, 2""",
    "tumble_event_built_in": f"""
WITH {_BATCHED}
SELECT event_type, window_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM split WHERE NOT is_late GROUP BY 1, 2""",
    "late_batch_stream": f"""
WITH {_BATCHED}
SELECT CASE WHEN is_late THEN 'late' ELSE 'main' END AS sink, event_type, window_start, count(*) AS n,
       CAST(sum(cents) AS BIGINT) AS cents
FROM split GROUP BY 1, 2, 3""",
    "late_log_stream": f"""
WITH {_TRACED}
SELECT dense_rank() OVER (ORDER BY arrival // {BATCH}) - 1 AS batch, count(*) AS n_rows,
       CAST(count(*) FILTER (is_late) AS BIGINT) AS n_late, max(max(t)) OVER (ORDER BY arrival // {BATCH}) AS max_ts
FROM split GROUP BY arrival // {BATCH}""",
    "late_changes_stream": f"""
WITH {_ARRIVALS}
SELECT event_type, (t // {HOUR}) * {HOUR} AS window_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents,
       CAST(1 AS BIGINT) AS results
FROM a GROUP BY 1, 2""",
    "timestamp_assign": "SELECT event_id, epoch_us(ts) // 1000 AS t_ms FROM events",
    "watermark_trace": f"WITH {_TRACED} SELECT event_id, watermark FROM traced",
    "watermark_trace_inputs": f"""
WITH {_ARRIVALS}, inputs AS (
    SELECT DISTINCT event_type AS input FROM a
), each AS (
    SELECT event_id, arrival, input,
           max(CASE WHEN event_type = input THEN t END) OVER met AS seen,
           max(CASE WHEN event_type = input THEN arrival END) OVER met AS came, min(arrival) OVER met AS begun
    FROM a CROSS JOIN inputs
    WINDOW met AS (PARTITION BY input ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), least AS (
    SELECT event_id, arrival,
           CASE WHEN count(seen) = count(*) THEN min(seen) END AS all_least,
           CASE WHEN count(*) FILTER (WHERE counts AND seen IS NULL) = 0 THEN min(seen) FILTER (WHERE counts) END AS least
    FROM (SELECT *, coalesce(arrival - coalesce(came, begun) <= {IDLE}, true) AS counts FROM each)
    GROUP BY event_id, arrival
)
SELECT event_id, max(least) OVER so_far - {LATE_BOUND} AS watermark,
       max(all_least) OVER so_far - {LATE_BOUND} AS without_release
FROM least WINDOW so_far AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "no_watermark_open_windows": f"""
SELECT event_type, (epoch_us(ts) // {HOUR}) * {HOUR} AS window_start, count(*) AS n, false AS emitted
FROM events GROUP BY 1, 2""",
    "window_emission": f"""
WITH {_TRACED}, w AS (
    SELECT window_end, (SELECT min(arrival) FROM a WHERE a.t - {LATE_BOUND} >= x.window_end) AS emit_arrival
    FROM (SELECT DISTINCT window_end FROM split WHERE NOT is_late) x
)
SELECT window_end, emit_arrival,
       CASE WHEN emit_arrival IS NULL THEN 'end_of_input' ELSE 'watermark' END AS emitted_by
FROM w""",
    "late_side_output": f"""
WITH {_TRACED}
SELECT event_id, user_id, event_type, cents, t, arrival FROM split WHERE is_late""",
    "late_main_output": f"""
WITH {_TRACED}
SELECT event_type, window_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM split WHERE NOT is_late GROUP BY 1, 2""",
    "late_two_sinks": f"""
WITH {_TRACED}
SELECT CASE WHEN is_late THEN 'late' ELSE 'main' END AS sink, event_type, window_start, count(*) AS n,
       CAST(sum(cents) AS BIGINT) AS cents
FROM split GROUP BY 1, 2, 3""",
    "late_windows_fold_stream": f"""
WITH {_TRACED}
SELECT event_type, window_start,
       CAST(2 * arg_min(cents, (arrival, event_id)) - sum(cents) AS BIGINT) AS cents,
       arg_min(t, (arrival, event_id)) AS t
FROM split WHERE NOT is_late GROUP BY 1, 2""",
    "late_report": f"""
WITH {_TRACED}
SELECT event_type, count(*) AS n_late, CAST(sum(cents) AS BIGINT) AS late_cents
FROM split WHERE is_late GROUP BY 1""",
    "late_correction": f"""
WITH {_TRACED}, main AS (
    SELECT event_type, window_start, CAST(sum(cents) AS BIGINT) AS main
    FROM split WHERE NOT is_late GROUP BY 1, 2
), late AS (
    SELECT event_type, window_start, CAST(sum(cents) AS BIGINT) AS late
    FROM split WHERE is_late GROUP BY 1, 2
)
SELECT event_type, window_start, main.main, late.late,
       coalesce(main.main, 0) + coalesce(late.late, 0) AS corrected
FROM main FULL OUTER JOIN late USING (event_type, window_start)""",
}

# Limits and batches decide how the work is spread, not what comes out.
ORACLES |= {
    "flat_map_udf": ORACLES["flat_map_words"],
    "tumble_arrival_stream": ORACLES["tumble_arrival_sum"],
    "tumble_arrival_clock": ORACLES["tumble_arrival_sum"],
    "late_correction_stream": ORACLES["late_correction"],
    "keyed_sum_rolling_cut": ORACLES["keyed_sum_rolling"],
    "tumble_udaf_reduce_cut": ORACLES["tumble_udaf_reduce"],
    "count_window_stream": ORACLES["count_window_sum"],
    "count_window_sum_cut": ORACLES["count_window_sum"],
    "late_main_output_salted": ORACLES["late_main_output"],
}
