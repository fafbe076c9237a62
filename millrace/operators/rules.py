"""Validation: rules that drop a record, null a field or set a default."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from ..functions import text as T
from ..schemas import SCORE_KEY


@dataclass(frozen=True)
class Rule:
    """action drop: `test` true gives `name` as the reason, the first rule in order winning. action set: `column` becomes `value`."""

    name: str
    action: str
    test: Column | None = None
    column: str | None = None
    value: Column | None = None


def drop(name: str, test: Column) -> Rule:
    return Rule(name, "drop", test)


def put(column: str, value: Column) -> Rule:
    return Rule(column, "set", column=column, value=value)


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """df with the set fields and a column drop_reason, null for rows that pass. Reasons are tested on the incoming fields."""
    reason = F.lit(None).cast("string")
    for r in reversed([r for r in rules if r.action == "drop"]):
        reason = F.when(F.coalesce(r.test, F.lit(False)), F.lit(r.name)).otherwise(reason)
    sets = {r.column: r.value for r in rules if r.action == "set"}
    return df.withColumns({"drop_reason": reason, **sets})


def passed(df: DataFrame) -> DataFrame:
    return df.where("drop_reason is null").drop("drop_reason")


def drop_counts(df: DataFrame) -> DataFrame:
    return df.where("drop_reason is not null").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


def blank(c: str) -> Column:
    return F.coalesce(T.strip(c), F.lit("")) == ""


def score_rules(as_of, low: float = 0, high: float = 100, years: tuple[int, int] = (2018, 2030)) -> list[Rule]:
    year, cut = T.to_int("year"), T.strip("cutoff_score")
    number = F.when(cut.rlike(T._NUMBER), cut).try_cast("double")
    q = T.to_int("quota")
    return [
        drop("university_code missing", blank("university_code")), drop("major_name_raw missing", blank("major_name_raw")), drop("year missing", F.col("year").isNull()),
        drop("year not an integer", year.isNull()), drop("year out of range", ~year.between(*years)),
        put("year", year.cast("smallint")), put("cutoff_score", F.round(T.in_range(number, low, high), 2).cast("decimal(5,2)")),
        put("quota", F.when(q > 0, q)), put("source_url", F.when(T.is_url("source_url"), F.col("source_url"))), put("scraped_at", F.coalesce(F.col("scraped_at"), F.lit(as_of).cast("timestamp"))),
    ]


def university_rules(as_of) -> list[Rule]:
    year = T.to_int("established_year")
    code_ok = F.regexp_replace(T.strip("university_code"), "-", "").rlike(r"(?U)^[\p{L}\p{N}]+$") & F.length(T.strip("university_code")).between(2, 20)
    urls = [put(c, F.when(T.is_url(c), F.col(c))) for c in ("website", "admission_url", "logo_url", "source_url")]
    return [
        drop("university_code missing", blank("university_code")), drop("name missing", blank("name")), drop("university_code malformed", ~code_ok),
        put("university_type", F.when(F.col("university_type").isin("public", "private", "foreign_affiliated"), F.col("university_type"))),
        put("region", F.when(F.col("region").isin("north", "central", "south"), F.col("region"))), *urls,
        put("established_year", F.when(year.between(1800, 2100), year).cast("smallint")), put("scraped_at", F.coalesce(F.col("scraped_at"), F.lit(as_of).cast("timestamp"))),
    ]


MAJOR_LISTS = ("career_options", "required_skills", "subject_combinations", "holland_types", "career_anchor_tags")
#: Codes of scraped majors, and of stored ones, which may have been made up.
SCRAPED_CODE, STORED_CODE = r"^\d{7}$", r"^(\d{7}|AUTO-[A-Z0-9]{6})$"


def listed(df: DataFrame, columns: tuple[str, ...] = MAJOR_LISTS) -> DataFrame:
    """List fields that came as one text as lists of it; an empty text is an empty list."""
    plain = [c for c in columns if df.schema[c].dataType.simpleString() == "string"]
    return df.withColumns({c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(c)) for c in plain}) if plain else df


def major_rules(as_of, code_form: str = SCRAPED_CODE) -> list[Rule]:
    lists = MAJOR_LISTS
    allowed = F.array(*[F.lit(x) for x in "RIASEC"])
    held = F.coalesce(F.col("holland_types"), F.array().cast("array<string>"))
    return [
        drop("major_code missing", blank("major_code")), drop("name missing", blank("name")), drop("major_code malformed", ~F.col("major_code").rlike(code_form)),
        drop("name length", ~F.length(T.strip("name")).between(2, 300)), drop("holland_types unknown", F.size(F.array_except(held, allowed)) > 0),
        drop("major_group length", F.length(T.strip("major_group")) > 100), drop("major_group_code length", F.length(T.strip("major_group_code")) > 10),
        drop("study_duration out of range", ~T.to_int("study_duration").between(1, 10)),
        *[put(c, F.coalesce(F.col(c), F.array().cast("array<string>"))) for c in lists],
        put("degree_level", F.when(F.col("degree_level").isin("bachelor", "engineer", "master"), F.col("degree_level")).otherwise(F.lit("bachelor"))),
        put("scraped_at", F.coalesce(F.col("scraped_at"), F.lit(as_of).cast("timestamp"))),
    ]


#: The rules of each type of record.
BY_TYPE = {"score": score_rules, "university": university_rules, "major": major_rules}


def validate_by_type(records: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """Each type's records by its rules; types without rules pass as they are, without a reason column, and are not counted."""
    return {kind: validate(listed(df) if kind == "major" else df, BY_TYPE[kind](as_of)) if kind in BY_TYPE else df for kind, df in records.items()}


def strict_rules(as_of, year: int) -> list[Rule]:
    """The documented rule set: codes of 2 to 10, scores 10 to 30, years up to the next."""
    return [drop("code format", ~T.code("university_code").rlike("^[A-Z0-9-]{2,10}$")), drop("score range", ~T.score("cutoff_score").between(10, 30)), *score_rules(as_of, 10, 30, (2018, year + 1))]


def store_contract(df: DataFrame) -> DataFrame:
    """The stored table's contract: unknown methods and combinations take their general code, scores are rounded, texts cut; a column
    error tells a score out of range, and is null for rows that may be stored."""
    return df.withColumns({
        "admission_method": F.when(T.strip("admission_method").isin(list(M.METHODS)), T.strip("admission_method")).otherwise(F.lit("khac")),
        "subject_combination": F.when(F.upper(T.strip("subject_combination")).isin(M.COMBOS), F.upper(T.strip("subject_combination"))).otherwise(F.lit("KHAC")),
        "note": T.opt_text("note", 1000), "source_url": T.opt_text("source_url", 500), "cutoff_score": F.round("cutoff_score", 2).cast("decimal(5,2)"),
        "error": F.when(~F.col("cutoff_score").between(0, 100), "cutoff_score out of range"),
    })


def score_contract() -> Column:
    """What a score's contract says against it: the fields that must be there and the numbers that must be numbers."""
    cut, q = F.col("cutoff_score").cast("string"), F.col("quota").cast("string")
    return errors(
        university_code__missing=~blank("university_code"), major_name_raw__missing=~blank("major_name_raw"), year__not_an_integer=T.to_int(F.col("year").cast("string")).isNotNull(),
        cutoff_score__not_a_number=cut.isNull() | cut.rlike(T._NUMBER), quota__not_an_integer=q.isNull() | T.to_int(q).isNotNull(), scraped_at__missing=F.col("scraped_at").isNotNull(),
    )


def table_checks(scores: DataFrame, universities: DataFrame, majors: DataFrame) -> DataFrame:
    """check, violations: the stored table's ranges, its key and its references."""
    n = F.count(F.lit(1)).alias("violations")
    key = [F.col(k) for k in SCORE_KEY]
    parts = {
        "cutoff_score in range": scores.where(~F.col("cutoff_score").between(0, 100)).agg(n), "year in range": scores.where(~F.col("year").between(2018, 2030)).agg(n),
        "key unique": scores.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("violations")),
        "university known": scores.join(universities.select(F.col("id").alias("university_id")), "university_id", "left_anti").agg(n),
        "major known": scores.join(majors.select(F.col("id").alias("major_id")), "major_id", "left_anti").agg(n),
    }
    return reduce(DataFrame.unionByName, [p.select(F.lit(k).alias("check"), "violations") for k, p in parts.items()])


def errors(**checks: Column) -> Column:
    """The messages of the checks that fail, as `field: message` texts."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name.replace("__", ": ").replace("_an_", " an ").replace("_a_", " a ") if "__not_" in name else name.replace("__", ": "))) for name, ok in checks.items()]), lambda m: m.isNotNull())
