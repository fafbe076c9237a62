"""Normalisation: one projection for each kind of record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from ..functions import text as T


def scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "university_code": T.code("university_code"), "major_name": T.major_name("major_name_raw"), "major_code": T.blank_to_null(T.strip("major_code")),
        "year": F.col("year").cast("smallint"), "admission_method": T.method("admission_method"), "subject_combination": T.combo("subject_combination"),
        "cutoff_score": T.score(F.col("cutoff_score").cast("string")), "quota": T.quota(F.col("quota").cast("string")),
        "note": T.blank_to_null(T.field("note", 500)), "source_url": T.opt_text("source_url", 500),
    })


def universities(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "university_code": T.code("university_code"), "name": T.field("name", 300), "short_name": T.short_name("short_name"),
        "university_type": T.label("university_type", M.TYPES), "region": T.label("region", M.REGIONS),
        "province": T.blank_to_null(T.field("province", 200)), "address": T.blank_to_null(T.field("address", 200)),
        **{c: T.opt_text(c, 500) for c in ("website", "admission_url", "logo_url", "source_url")},
        "tuition_min": T.to_int("tuition_min"), "tuition_max": T.to_int("tuition_max"), "established_year": T.to_int(F.col("established_year").cast("string")),
    })


def majors(df: DataFrame) -> DataFrame:
    duration = T.to_int(F.col("study_duration").cast("string"))
    combos = T.combos("subject_combinations") if df.schema["subject_combinations"].dataType.simpleString() == "string" else F.array_distinct(F.transform("subject_combinations", T.combo))
    holland = F.array_distinct(F.filter(F.transform("holland_types", lambda h: F.upper(T.strip(h))), lambda h: h.isin(list("RIASEC"))))
    return df.withColumns({
        "major_code": T.strip("major_code"), **{c: T.strip(c) for c in ("major_group", "major_group_code") if c in df.columns}, "name": F.coalesce(T.blank_to_null(T.major_name("name")), T.strip("name")),
        "description": T.blank_to_null(T.field("description", 5000)), "subject_combinations": combos, "holland_types": holland,
        **{c: T.texts(c) for c in ("career_options", "required_skills", "career_anchor_tags")},
        "study_duration": F.when(duration.between(1, 10), duration).cast("smallint"), "degree_level": T.label("degree_level", M.DEGREES, "bachelor"),
    })


def counters(before: DataFrame, after: DataFrame) -> DataFrame:
    """normalized, and of the rows that came without a code those that have one now and those that have none, and the combinations known.
    before and after: score records with ingest_seq."""
    had = before.select("ingest_seq", (F.coalesce(T.strip("major_code"), F.lit("")) == "").alias("lacked"))
    x = after.select("ingest_seq", "major_code", "subject_combination").join(had, "ingest_seq")
    return x.agg(
        F.count(F.lit(1)).alias("normalized"), F.count_if(F.col("lacked") & F.col("major_code").isNotNull()).alias("resolved"), F.count_if(F.col("lacked") & F.col("major_code").isNull()).alias("unresolved"),
        F.count_if(F.col("subject_combination") != "KHAC").alias("combos"),
    )
