"""Declared schemas of both dialects (explicit StructTypes; never inferSchema)."""

from pyspark.sql import types as T

S, D, L, I, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# long dialect (string subject ids)
MEASURES_LONG = _st(("subject_id", S), ("metric", S), ("phase", S), ("week", I), ("value", D), ("tp_index", L),
                    ("timepoint", S), ("note", S), ("sheet_name", S), ("source_path", S))
NUTRITION_ROWS_LONG = _st(("subject_id", S), ("date", DT), ("food", S), ("fiber_g", D), ("calories_kcal", D),
                          ("carb_g", D), ("protein_g", D), ("fat_g", D), ("sugar_g", D), ("insoluble_fiber_g", D),
                          ("soluble_fiber_g", D), ("sheet_name", S), ("source_path", S))
DAILY_LONG = _st(("subject_id", S), ("date", DT), ("fiber_g_total", D), ("calories_kcal_total", D),
                 ("carb_g_total", D), ("protein_g_total", D), ("fat_g_total", D), ("n_entries", L))

# wide dialect (integer subject ids)
MEASURES_WIDE = _st(("subject_id", L), ("date", DT), ("week", I), ("weight_kg", D), ("energy_1_10", D), ("mood_1_10", D))
NUTRITION_ROWS_WIDE = _st(("subject_id", L), ("date", DT), ("food_item", S), ("category", S), ("calories", D),
                          ("protein_g", D), ("carbs_g", D), ("fat_g", D), ("fiber_g", D))
DAILY_WIDE = _st(("subject_id", L), ("date", DT), ("week", I), ("total_calories", D), ("total_fiber_g", D))

# run step log used by the run-metrics operators
STEPS = _st(("run_id", S), ("step", S), ("started_at", T.TimestampType()), ("seconds", D), ("status", S), ("rows_out", L))
