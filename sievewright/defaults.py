"""Default configuration for versioned job-postings dumps."""

from __future__ import annotations

from sievewright.specs import (
    BridgeJoin,
    CanonicalColumn,
    CanonicalSchema,
    CleaningRule,
    DimensionJoin,
    FeatureConfig,
    InvalidValuePolicy,
    NullPolicy,
    Reference,
    SalaryConfig,
    SnapshotJoin,
    TableRules,
    ValueRule,
)

# ---------------------------------------------------------------------------
# Table and file names, column names, aliases and types of the
# dump format.
# ---------------------------------------------------------------------------

MANDATORY_FILES = {
    "postings": ("postings.csv", "job_postings.csv"),
    "companies": ("companies.csv",),
    "industries": ("industries.csv",),
    "job_industries": ("job_industries.csv",),
}
OPTIONAL_FILES = {
    "benefits": ("benefits.csv",),
    "company_specialities": ("company_specialities.csv",),
    "employee_counts": ("employee_counts.csv",),
    "job_skills": ("job_skills.csv",),
    "skills": ("skills.csv",),
    "salaries": ("salaries.csv",),
}

SCHEMAS = {
    "postings": CanonicalSchema(
        (
            CanonicalColumn("job_id", "bigint", ("job_id", "id"), required=True),
            CanonicalColumn("company_id", "bigint"),
            CanonicalColumn("title", "string", ("title", "job_title")),
            CanonicalColumn("description", "string", ("description", "job_description")),
            CanonicalColumn("location", "string"),
            CanonicalColumn("views", "bigint"),
            CanonicalColumn("applies", "bigint"),
            CanonicalColumn("min_salary", "double"),
            CanonicalColumn("med_salary", "double"),
            CanonicalColumn("max_salary", "double"),
            CanonicalColumn("pay_period", "string"),
            CanonicalColumn("currency", "string"),
            CanonicalColumn("compensation_type", "string"),
            CanonicalColumn("normalized_salary", "double"),
            CanonicalColumn("formatted_work_type", "string", ("formatted_work_type", "work_type_name")),
            CanonicalColumn("work_type", "string"),
            CanonicalColumn("remote_allowed", "double"),
            CanonicalColumn("formatted_experience_level", "string", ("formatted_experience_level", "experience_level")),
            CanonicalColumn("listed_time", "double"),
            CanonicalColumn("original_listed_time", "double"),
            CanonicalColumn("expiry", "double"),
            CanonicalColumn("closed_time", "double"),
            CanonicalColumn("sponsored", "bigint"),
            CanonicalColumn("zip_code", "string"),
            CanonicalColumn("fips", "double"),
        )
    ),
    "companies": CanonicalSchema(
        (
            CanonicalColumn("company_id", "bigint", required=True),
            CanonicalColumn("name", "string", ("name", "company_name")),
            CanonicalColumn("description", "string"),
            CanonicalColumn("company_size", "double"),
            CanonicalColumn("state", "string"),
            CanonicalColumn("country", "string"),
            CanonicalColumn("city", "string"),
            CanonicalColumn("zip_code", "string"),
            CanonicalColumn("address", "string"),
            CanonicalColumn("url", "string"),
        )
    ),
    "industries": CanonicalSchema(
        (
            CanonicalColumn("industry_id", "bigint", required=True),
            CanonicalColumn("industry_name", "string"),
        )
    ),
    "job_industries": CanonicalSchema(
        (
            CanonicalColumn("job_id", "bigint", required=True),
            CanonicalColumn("industry_id", "bigint", required=True),
        )
    ),
    "benefits": CanonicalSchema(
        (
            CanonicalColumn("job_id", "bigint", required=True),
            CanonicalColumn("inferred", "bigint"),
            CanonicalColumn("type", "string"),
        )
    ),
    "company_specialities": CanonicalSchema(
        (
            CanonicalColumn("company_id", "bigint", required=True),
            CanonicalColumn("speciality", "string"),
        )
    ),
    "employee_counts": CanonicalSchema(
        (
            CanonicalColumn("company_id", "bigint", required=True),
            CanonicalColumn("employee_count", "bigint"),
            CanonicalColumn("follower_count", "bigint"),
            CanonicalColumn("time_recorded", "double"),
        )
    ),
    "job_skills": CanonicalSchema(
        (
            CanonicalColumn("job_id", "bigint", required=True),
            CanonicalColumn("skill_abr", "string"),
        )
    ),
    "skills": CanonicalSchema(
        (
            CanonicalColumn("skill_abr", "string", required=True),
            CanonicalColumn("skill_name", "string"),
        )
    ),
    "salaries": CanonicalSchema(
        (
            CanonicalColumn("salary_id", "bigint"),
            CanonicalColumn("job_id", "bigint", required=True),
            CanonicalColumn("max_salary", "double"),
            CanonicalColumn("med_salary", "double"),
            CanonicalColumn("min_salary", "double"),
            CanonicalColumn("pay_period", "string"),
            CanonicalColumn("currency", "string"),
            CanonicalColumn("compensation_type", "string"),
        )
    ),
}

# ---------------------------------------------------------------------------
# Relations, vocabularies and bounds of the validation rules.
# Times are epoch milliseconds between the years 2000 and 2100.
# ---------------------------------------------------------------------------

REFERENCES = {
    "postings": (Reference("company_id", "companies", "company_id"),),
    "job_industries": (
        Reference("job_id", "postings", "job_id"),
        Reference("industry_id", "industries", "industry_id"),
    ),
    "benefits": (Reference("job_id", "postings", "job_id"),),
    "company_specialities": (Reference("company_id", "companies", "company_id"),),
    "employee_counts": (Reference("company_id", "companies", "company_id"),),
    "job_skills": (
        Reference("job_id", "postings", "job_id"),
        Reference("skill_abr", "skills", "skill_abr"),
    ),
    "salaries": (Reference("job_id", "postings", "job_id"),),
}

_NOT_NEGATIVE = ValueRule(minimum=0)
_TIME = ValueRule(minimum=946684800000, maximum=4102444800000)
WORK_TYPES = ("FULL_TIME", "PART_TIME", "CONTRACT", "TEMPORARY", "INTERNSHIP", "VOLUNTEER", "OTHER")
EXPERIENCE_LEVELS = ("Internship", "Entry level", "Associate", "Mid-Senior level", "Director", "Executive")
PAY_PERIODS = ("HOURLY", "WEEKLY", "BIWEEKLY", "MONTHLY", "YEARLY", "ONCE")

VALIDATION_RULES = {
    "postings": TableRules(
        unique_key=("job_id",),
        not_null=("job_id", "company_id", "title"),
        values={
            "min_salary": _NOT_NEGATIVE,
            "max_salary": _NOT_NEGATIVE,
            "listed_time": _TIME,
            "original_listed_time": _TIME,
            "expiry": _TIME,
            "closed_time": _TIME,
            "remote_allowed": ValueRule(allowed=(0, 1)),
            "work_type": ValueRule(allowed=WORK_TYPES),
            "formatted_experience_level": ValueRule(allowed=EXPERIENCE_LEVELS),
            "pay_period": ValueRule(allowed=PAY_PERIODS),
        },
        references=REFERENCES["postings"],
    ),
    "companies": TableRules(unique_key=("company_id",), not_null=("company_id", "name")),
    "industries": TableRules(unique_key=("industry_id",), not_null=("industry_id", "industry_name")),
    "job_industries": TableRules(
        unique_key=("job_id", "industry_id"),
        not_null=("job_id", "industry_id"),
        references=REFERENCES["job_industries"],
    ),
    "benefits": TableRules(not_null=("job_id",), references=REFERENCES["benefits"]),
    "company_specialities": TableRules(not_null=("company_id",), references=REFERENCES["company_specialities"]),
    "employee_counts": TableRules(
        not_null=("company_id",),
        values={"employee_count": _NOT_NEGATIVE, "follower_count": _NOT_NEGATIVE},
        references=REFERENCES["employee_counts"],
    ),
    "job_skills": TableRules(not_null=("job_id", "skill_abr"), references=REFERENCES["job_skills"]),
    "skills": TableRules(unique_key=("skill_abr",), not_null=("skill_abr",)),
    "salaries": TableRules(
        not_null=("job_id",),
        values={"min_salary": _NOT_NEGATIVE, "max_salary": _NOT_NEGATIVE},
        references=REFERENCES["salaries"],
    ),
}

# ---------------------------------------------------------------------------
# Cleaning policies.
# ---------------------------------------------------------------------------

CLEANING_RULES = {
    "companies": CleaningRule(
        key=("company_id",),
        null_policies={"name": NullPolicy.FILL_DEFAULT},
        fill_values={"name": "Unknown Company"},
    ),
    "postings": CleaningRule(
        key=("job_id",),
        null_policies={"company_id": NullPolicy.DROP_ROW},
        references=REFERENCES["postings"],
    ),
    "industries": CleaningRule(
        key=("industry_id",),
        null_policies={"industry_name": NullPolicy.FILL_DEFAULT},
        fill_values={"industry_name": "Unspecified"},
        lowercase=("industry_name",),
    ),
    "skills": CleaningRule(key=("skill_abr",), lowercase=("skill_name",)),
    "job_industries": CleaningRule(key=("job_id", "industry_id"), references=REFERENCES["job_industries"]),
    "benefits": CleaningRule(references=REFERENCES["benefits"], lowercase=("type",)),
    "company_specialities": CleaningRule(references=REFERENCES["company_specialities"], lowercase=("speciality",)),
    "employee_counts": CleaningRule(references=REFERENCES["employee_counts"]),
    "job_skills": CleaningRule(key=("job_id", "skill_abr"), references=REFERENCES["job_skills"]),
    "salaries": CleaningRule(
        references=REFERENCES["salaries"],
        minimums={"med_salary": 0.0, "min_salary": 0.0, "max_salary": 0.0},
        invalid_values=InvalidValuePolicy.DROP_ROW,
    ),
}

# ---------------------------------------------------------------------------
# Joins of the master table.
# ---------------------------------------------------------------------------

DIMENSIONS = (
    DimensionJoin(
        "companies",
        "company_id",
        "company_id",
        rename={
            "name": "company_name",
            "description": "company_description",
            "state": "company_state",
            "country": "company_country",
            "city": "company_city",
            "zip_code": "company_zip_code",
            "address": "company_address",
            "url": "company_url",
        },
    ),
)
SNAPSHOTS = (
    SnapshotJoin(
        "employee_counts",
        "company_id",
        "company_id",
        latest_by="time_recorded",
        rename={
            "employee_count": "company_employee_count",
            "follower_count": "company_follower_count",
            "time_recorded": "company_employee_count_recorded_at",
        },
    ),
    SnapshotJoin(
        "salaries",
        "job_id",
        "job_id",
        rename={
            "min_salary": "listed_min_salary",
            "max_salary": "listed_max_salary",
            "med_salary": "listed_med_salary",
            "pay_period": "listed_pay_period",
            "currency": "listed_currency",
            "compensation_type": "listed_compensation_type",
        },
    ),
)
BRIDGES = (
    BridgeJoin("job_industries", "job_id", "industry_id", "industry", "industries", "industry_id", "industry_name"),
    BridgeJoin("job_skills", "job_id", "skill_abr", "skill", "skills", "skill_abr", "skill_name"),
    BridgeJoin("benefits", "job_id", "type", "benefit"),
    BridgeJoin("company_specialities", "company_id", "speciality", "speciality"),
)

# ---------------------------------------------------------------------------
# Feature-store column groups and fill strategies.
# ---------------------------------------------------------------------------

FEATURES = FeatureConfig(
    identifiers=("job_id", "company_id", "salary_id"),
    # the snapshot join renames time_recorded, so the renamed column is listed
    epoch_ms=("listed_time", "original_listed_time", "expiry", "closed_time", "company_employee_count_recorded_at"),
    booleans=("remote_allowed", "sponsored"),
    categories=(
        "formatted_work_type",
        "work_type",
        "formatted_experience_level",
        "pay_period",
        "compensation_type",
        "currency",
        "application_type",
        "company_size",
        "company_state",
        "company_country",
        "company_city",
    ),
    texts=("title", "description", "company_name", "company_description", "location", "company_address"),
    lists=("skill_list", "benefit_list", "industry_list", "speciality_list"),
    fill_strategies={
        "max_salary": "leave",
        "med_salary": "leave",
        "min_salary": "leave",
        "normalized_salary": "leave",
        "views": "median",
        "applies": "median",
        "company_employee_count": "median",
        "company_follower_count": "median",
        "zip_code": "leave",
        "fips": "leave",
        "formatted_experience_level": "constant",
        "company_size": "constant",
    },
    fill_constants={"formatted_experience_level": "UNKNOWN", "company_size": "UNKNOWN"},
    salary_columns=("min_salary", "max_salary", "med_salary", "normalized_salary"),
    presence_flags={
        "has_description": ("description",),
        "has_company_description": ("company_description",),
        "listing_age_available": ("listed_time", "expiry"),
    },
    list_counts={
        "skill_count": "skill_list",
        "benefit_count": "benefit_list",
        "industry_count": "industry_list",
        "speciality_count": "speciality_list",
    },
)

# ---------------------------------------------------------------------------
# Salary target, predictors and the leakage list.
# ---------------------------------------------------------------------------

SALARY = SalaryConfig(
    periods_per_year={"yearly": 1.0, "monthly": 12.0, "biweekly": 26.0, "weekly": 52.0, "hourly": 2080.0},
    predictors=(
        "title",
        "formatted_experience_level",
        "formatted_work_type",
        "company_state",
        "company_country",
        "company_size",
        "company_employee_count",
        "company_follower_count",
        "top_industry",
        "top_skill",
        "skill_list",
        "skill_count",
    ),
    metadata=("company_name", "location", "original_listed_time", "listed_time", "dataset_version"),
    leakage=(
        "min_salary",
        "med_salary",
        "max_salary",
        "normalized_salary",
        "listed_min_salary",
        "listed_med_salary",
        "listed_max_salary",
        "salary_available",
        "views",
        "applies",
        "closed_time",
        "expiry",
        "dataset_version",
        "pay_period",
        "currency",
        "listed_currency",
        "listed_pay_period",
        "listed_compensation_type",
    ),
    group_parts=("title", "company_name", "location"),
    log_features=("company_employee_count", "company_follower_count"),
)

# Word lists of the text queries.
SENIORITY_KEYWORDS = (
    "intern",
    "junior",
    "jr",
    "associate",
    "senior",
    "sr",
    "lead",
    "staff",
    "principal",
    "manager",
    "director",
    "head",
    "vp",
    "vice president",
    "chief",
)
TITLE_STOP_WORDS = ("and", "or", "the", "a", "an", "of", "in", "for", "to", "at", "on", "with")
SALARY_PATTERNS = (r"\$", r"salary", r"compensation", r"\bpay\b", r"per hour", r"per year", r"annually")
SALARY_SNIPPET_TERMS = ("salary", "compensation", "$", "per hour", "per year", "annually")
