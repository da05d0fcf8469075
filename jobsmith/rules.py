"""Rule tables for enrichment and CSV null handling.

FIXED VALUES: the lists below must equal the published rule set so that
skills, role and seniority labels agree with the upstream job-posting
pipeline. They are data, not logic; callers may pass their own tables.
"""

from __future__ import annotations

# --- fixed values: skill keywords (matched as whole words, lower case) ---
SKILL_KEYWORDS: list[str] = [
    "python", "sql", "docker", "kafka", "airflow", "aws", "gcp", "azure",
    "power bi", "tableau", "spark", "dbt", "postgres", "postgresql", "react",
    "typescript", "kubernetes", "selenium", "pytorch",
]

# --- fixed values: role rules, ordered; first label with a substring hit wins ---
ROLE_RULES: list[tuple[str, list[str]]] = [
    ("Data", ["data engineer", "data engineering", "etl", "analytics engineer", "data platform"]),
    ("ML", ["machine learning", "ml engineer", "data scientist", "llm", "nlp", "ai engineer"]),
    ("Analyst", ["data analyst", "bi analyst", "business intelligence", "analytics", "reporting"]),
    ("Backend", ["backend", "api", "microservice", "server-side", "backend engineer"]),
    ("Frontend", ["frontend", "front-end", "front end", "react", "vue", "angular", "ui engineer",
                  "web developer"]),
    ("DevOps", ["devops", "dev ops", "sre", "site reliability", "platform engineer", "infrastructure"]),
    ("Full-stack", ["full-stack", "full stack", "fullstack", "full stack developer"]),
    ("Mobile", ["mobile developer", "ios developer", "android developer", "react native", "flutter"]),
    ("QA", ["qa engineer", "quality assurance", "test engineer", "sdet", "automation testing"]),
    ("Product", ["product manager", "product owner", "technical pm"]),
    ("Security", ["security engineer", "cybersecurity", "application security", "devsecops"]),
]
ROLE_DEFAULT = "Other"

# --- fixed values: seniority rules, ordered; first label with a whole-word hit wins ---
SENIORITY_RULES: list[tuple[str, list[str]]] = [
    ("Junior", ["junior", "entry", "intern", "graduate"]),
    ("Senior", ["senior", "staff", "principal", "lead", "architect"]),
    ("Mid", ["mid", "intermediate"]),
]
SENIORITY_DEFAULT = "Unspecified"

# --- fixed values: default CSV NA tokens (read as NULL) ---
CSV_NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: other constants of the data contract ---
UNSPECIFIED_ROLE = "Unspecified"   # COALESCE default for role in daily metrics
TOP_K = 10                         # top companies / skills per day and overall
LATEST_STREAM_ROWS = 20            # newest stream rows on the report
API_SOURCE = "api"
CSV_SOURCE = "csv"
