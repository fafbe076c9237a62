"""The record pipeline: validate, normalise, resolve, dedup, store. Each stage is a DataFrame transform, and the stages of a run are a
list in order of priority that callers may add to.

A run's tables are a dict: raw (text records with ingest_seq), rows (what is left of them), dropped (reasons and counts), stored, the
dimensions, and in the end the merged table and the counters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, merge, metrics, normalize, resolve, rules
from ..schemas import SCORE_KEY

Tables = dict[str, DataFrame]
#: (priority, name, what it does to the tables of a run); lower priorities come first.
Stage = tuple[int, str, Callable[[Tables], Tables]]


def run_stages(tables: Tables, stages: list[Stage]) -> Tables:
    for _, _, apply in sorted(stages, key=lambda s: s[:2]):
        tables = {**tables, **apply(tables)}
    return tables


def cut(path: str, priority: int = 350) -> Stage:
    """A stage that writes the rows to a folder that driver and executors share and reads them back, so that what follows does not
    compute them again for each table. At a priority between those of dedup and resolve the raw records are read once: resolution looks at
    its rows several times."""

    def write(t: Tables) -> Tables:
        t["rows"].write.mode("overwrite").parquet(path)
        return {"rows": t["rows"].sparkSession.read.schema(t["rows"].schema).parquet(path)}

    return (priority, "cut", write)


def clean(raw: DataFrame, as_of: str, seq: str = "ingest_seq", rule_set=None) -> DataFrame:
    """Raw score records (text) with drop_reason; those without one are normalised."""
    checked = rules.validate(raw, rule_set or rules.score_rules(as_of))
    return normalize.scores(checked)


def resolve_ids(df: DataFrame, universities: DataFrame, majors: DataFrame) -> DataFrame:
    """University by code; major by code, then by name, then by the shortest active name that holds the keyword of the name. Unknown
    keys stay null. Of dimension rows that share a code or name the least id is taken."""
    u = universities.groupBy(F.upper(T.strip("university_code")).alias("key")).agg(F.min("id").alias("value"))
    by_code = majors.groupBy(F.col("major_code").alias("key")).agg(F.min("id").alias("value"))
    by_name = majors.groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("value"))
    out = resolve.cascade(df, [F.upper(T.strip("university_code"))], [u], "university_id")
    out = resolve.cascade(out, [F.col("major_code"), F.lower("major_name")], [by_code, by_name], "major_id").withColumn("__kw", T.keyword("major_name"))
    left = out.where("major_id is null and __kw is not null").select("__kw").distinct()
    top = resolve.ilike_top(left, "__kw", majors.where("is_active"), "name", "major_code").select("__kw", F.col("major_code").alias("key"))
    found = resolve.small(top.join(by_code, "key").select("__kw", F.col("value").alias("__found")))
    return out.join(found, "__kw", "left").withColumn("major_id", F.coalesce("major_id", "__found")).drop("__kw", "__found")


def _own_major(code: str = "major_code", name: str = "major_name"):
    """The id of a major that is made on the fly: by its code, or by its name where it has none."""
    return F.when(F.col(code).isNotNull(), T.key_id(code)).otherwise(T.key_id(T.name_key(name)))


def complete_dimensions(df: DataFrame, universities: DataFrame, majors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both dimensions with a row for every key of the resolved batch that has no id. Majors without a code are told apart by name: the
    made-up code is for display, and two names that share one stay two rows (see code_clashes)."""
    u = merge.with_missing(universities, df.where("university_id is null and university_code <> ''"), "university_code", _new_university())
    return u, majors.unionByName(new_majors(df), allowMissingColumns=True)


def _new_university() -> dict:
    return {"id": T.key_id("university_code"), "name": F.concat(F.lit("Trường "), F.col("university_code")), "university_type": F.lit("public"), "region": F.lit("south"), "is_active": F.lit(True)}


def new_universities(df: DataFrame) -> DataFrame:
    """A row for each university code of the resolved batch that has no id."""
    return df.where("university_id is null and university_code <> ''").select("university_code").distinct().withColumns(_new_university())


def new_majors(df: DataFrame) -> DataFrame:
    """A row for each major of the resolved batch that has no id."""
    lacking = df.where("major_id is null and university_code <> ''").select(_own_major().alias("id"), F.coalesce("major_code", T.auto_code("major_name")).alias("major_code"), F.col("major_name").alias("name"))
    new = lacking.groupBy("id").agg(F.min("major_code").alias("major_code"), F.min("name").alias("name"))
    return new.withColumns({"major_group_code": F.lit("000"), "study_duration": F.lit(4).cast("smallint"), "degree_level": F.lit("bachelor"), "is_active": F.lit(True)})


def code_clashes(majors: DataFrame) -> DataFrame:
    """Codes that several majors have, with their number."""
    return majors.groupBy("major_code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ready_scores(rows: DataFrame, as_of: str) -> DataFrame:
    """Resolved rows as the table takes them: ids of dimension rows that are made on the fly, the contract, one row a key. Keys may meet after
    the closed lists are applied, so the table's own key is deduplicated again."""
    rows = rows.withColumns({"university_id": F.coalesce("university_id", T.key_id("university_code")), "major_id": F.coalesce("major_id", _own_major())})
    ready = dedup.first_wins(rules.store_contract(rows).where("error is null").drop("error"), SCORE_KEY, ["ingest_seq"])
    return ready.withColumn("scraped_at", T.utc("scraped_at", as_of))


def merge_scores(stored: DataFrame, ready: DataFrame, policy: str) -> DataFrame:
    return merge.merge(stored, ready, SCORE_KEY, ["cutoff_score", "quota", "note", "scraped_at", "source_url"], policy)


def score_stages(as_of: str, policy: str = "skip", rule_set=None, names: DataFrame | None = None, cached: DataFrame | None = None, use_table: bool = False) -> list[Stage]:
    """The stages of score records. names: a dictionary (key, value, ord) for codes of names. Tiers of dedup take part if they are given:
    cached (key columns k1 to k5 of earlier runs), and with use_table the stored table, whose keys are then dropped before the merge."""
    keys = ["k1", "k2", "k3", "k4", "k5"]

    def validate(t: Tables) -> Tables:
        checked = rules.validate(t["raw"], rule_set or rules.score_rules(as_of))
        return {"rows": rules.passed(checked), "dropped": rules.drop_counts(checked)}

    def normalise(t: Tables) -> Tables:
        rows = normalize.scores(t["rows"])
        if names is not None:
            rows = resolve.code_of_name(rows, "major_name", names, "__code").withColumn("major_code", F.coalesce("major_code", "__code")).drop("__code")
        return {"rows": rows}

    def once(t: Tables) -> Tables:
        named = t["rows"].select("*", *dedup.score_key())
        if cached is not None:
            named = named.join(cached.select(*keys).distinct(), keys, "left_anti")
        return {"rows": dedup.first_wins(named, keys, ["ingest_seq"]).drop(*keys).where("university_code <> ''")}

    def identify(t: Tables) -> Tables:
        rows = resolve_ids(t["rows"], t["universities"], t["majors"])
        if use_table:
            rows = rows.join(t["stored"].select(*SCORE_KEY), SCORE_KEY, "left_anti")
        return {"rows": rows}

    def store(t: Tables) -> Tables:
        u, m = complete_dimensions(t["rows"], t["universities"], t["majors"])
        merged = merge_scores(t["stored"], ready_scores(t["rows"], as_of), policy)
        counts = metrics.counters(merged, new=F.col("action") == "inserted", updated=F.col("action") == "updated", unchanged=F.col("action") == "unchanged")
        return {"universities": u, "majors": m, "scores": merged, "counters": counts}

    return [(100, "validate", validate), (200, "normalise", normalise), (300, "dedup", once), (330, "resolve", identify), (400, "store", store)]


def prepare(raw: DataFrame, stored: DataFrame, universities: DataFrame, majors: DataFrame, as_of: str, more: list[Stage] | None = None, **options) -> Tables:
    """A run up to its store: resolved rows and drops, without a merge."""
    stages = [*(s for s in score_stages(as_of, **options) if s[1] != "store"), *(more or [])]
    return run_stages({"raw": raw, "stored": stored, "universities": universities, "majors": majors}, stages)


def run(raw: DataFrame, stored: DataFrame, universities: DataFrame, majors: DataFrame, as_of: str, policy: str = "skip", more: list[Stage] | None = None, **options) -> dict[str, DataFrame]:
    """raw: score records with ingest_seq. The new tables (scores, universities, majors), the drops and the run's counters. `more` are
    stages that are run among the others by their priority; options are those of score_stages."""
    out = run_stages({"raw": raw, "stored": stored, "universities": universities, "majors": majors}, [*score_stages(as_of, policy, **options), *(more or [])])
    return {k: out[k] for k in ("scores", "universities", "majors", "dropped", "counters")}


def dimension_stages(kind: str, as_of: str, policy: str = "coalesce") -> list[Stage]:
    """The stages of university or major records: rules, normalisation, first of each code, sink."""
    key, make, form = {"university": ("university_code", rules.university_rules, normalize.universities), "major": ("major_code", rules.major_rules, normalize.majors)}[kind]
    fields = {
        "university": "name short_name university_type region province address website admission_url logo_url tuition_min tuition_max established_year scraped_at source_url",
        "major": "name major_group major_group_code description career_options required_skills subject_combinations holland_types career_anchor_tags study_duration degree_level scraped_at source_url",
    }[kind].split()

    def validate(t: Tables) -> Tables:
        checked = rules.validate(t["raw"] if kind == "university" else rules.listed(t["raw"]), make(as_of))
        return {"rows": rules.passed(checked), "dropped": rules.drop_counts(checked)}

    def once(t: Tables) -> Tables:
        return {"rows": dedup.pass_blank(form(t["rows"]), key, ["ingest_seq"])}

    def store(t: Tables) -> Tables:
        merged, counts = merge.store(t["stored"], t["rows"], key, [key, "name"], fields, ["ingest_seq"], policy)
        return {"merged": merged, "counters": counts}

    return [(100, "validate", validate), (300, "dedup", once), (400, "store", store)]


def run_dimension(kind: str, raw: DataFrame, stored: DataFrame, as_of: str, policy: str = "coalesce") -> dict[str, DataFrame]:
    """raw: university or major records with ingest_seq; stored: their table. The merged table, the drops and the counters."""
    out = run_stages({"raw": raw, "stored": stored}, dimension_stages(kind, as_of, policy))
    return {k: out[k] for k in ("merged", "dropped", "counters")}
