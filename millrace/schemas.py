"""Schemas: raw records are text throughout; stored tables are typed, as DDL that readers take as it is."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str, lists: str = "") -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()] + [T.StructField(n, T.ArrayType(T.StringType())) for n in lists.split()])


RAW_SCORE = _strings("university_code major_name_raw major_code year admission_method subject_combination cutoff_score quota note scraped_at source_url")
RAW_UNIVERSITY = _strings("university_code name short_name university_type region province address website admission_url logo_url tuition_min tuition_max established_year scraped_at source_url")
RAW_MAJOR = _strings("major_code name major_group major_group_code description study_duration degree_level scraped_at source_url", "career_options required_skills subject_combinations holland_types career_anchor_tags")
JOB_CATEGORY = "name string, demand_level string, growth_trend string, source string, source_url string, avg_salary_min bigint, avg_salary_max bigint, median_salary bigint, job_count_sample int, top_skills array<string>, related_majors array<string>, scraped_at timestamp"
SCORE = "id string, university_id string, major_id string, year smallint, admission_method string, subject_combination string, cutoff_score decimal(5,2), quota bigint, note string, scraped_at timestamp, source_url string, created_at timestamp"
UNIVERSITY = "id string, university_code string, name string, short_name string, university_type string, region string, province string, address string, website string, admission_url string, logo_url string, tuition_min bigint, tuition_max bigint, established_year smallint, is_active boolean, scraped_at timestamp, source_url string, created_at timestamp, updated_at timestamp"
MAJOR = "id string, major_code string, name string, major_group string, major_group_code string, description string, career_options array<string>, required_skills array<string>, subject_combinations array<string>, holland_types array<string>, career_anchor_tags array<string>, study_duration smallint, degree_level string, is_active boolean, is_published boolean, scraped_at timestamp, source_url string, created_at timestamp, updated_at timestamp"
CRAWL_LOG = "id string, spider_name string, status string, started_at timestamp, finished_at timestamp, records_new int, records_updated int, records_failed int, error_summary string, triggered_by string"
#: A tag profile, and a seed row of the majors.
PROFILE = "ord int, types array<string>, anchors array<string>, keywords array<string>, codes array<string>"
MAJOR_SEED = "code string, name string, `group` string, holland string"
TABLES = {"admission_scores": SCORE, "universities": UNIVERSITY, "majors": MAJOR, "crawl_logs": CRAWL_LOG}
#: What makes a stored score one row.
SCORE_KEY = ["university_id", "major_id", "year", "admission_method", "subject_combination"]


def create_table(name: str, path: str) -> str:
    """The statement that makes a stored table over a folder of Parquet files."""
    return f"CREATE TABLE IF NOT EXISTS {name} ({TABLES[name]}) USING parquet LOCATION '{path}'"
