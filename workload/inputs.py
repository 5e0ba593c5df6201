"""Input tables of the registered queries, in Spark and as SQL.

Everything is read from the given tables or derived from them row by row. The prose in
``documents`` and ``benchmark`` is invented and holds no section headers, titles or
degrees, so profile and job texts wrap each whole text in short blocks chosen by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.operators import offsets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Small dimension tables -------------------------------------------------------------

# ordinal is the position in the list
TAXONOMY = [
    ("programming_languages", "Python"), ("programming_languages", "sql"), ("programming_languages", "r"),
    ("programming_languages", "c++"), ("programming_languages", "c#"), ("programming_languages", "c"),
    ("programming_languages", "the"), ("programming_languages", "der"), ("programming_languages", "then"),
    ("cloud_platforms", "aws"), ("cloud_platforms", "google cloud"), ("cloud_platforms", "in"),
    ("cloud_platforms", "of the"), ("cloud_platforms", "und"),
    ("databases", "sql"), ("databases", "postgresql"), ("databases", "and"), ("databases", "les"),
    ("ml_ai_frameworks", "scikit-learn"), ("ml_ai_frameworks", "pytorch"), ("ml_ai_frameworks", "is"),
    ("ml_ai_frameworks", "de la"), ("ml_ai_frameworks", "que"),
    ("big_data", "spark"), ("big_data", "data pipeline"), ("big_data", "with"), ("big_data", "das"),
    ("devops_tools", "ci/cd"), ("devops_tools", "docker"), ("devops_tools", "that"), ("devops_tools", "mit"),
    ("frameworks", ".net core"), ("frameworks", "node.js"), ("frameworks", "apache"), ("frameworks", "license"),
    ("visualization", "power bi"), ("visualization", "tableau"), ("visualization", "for"),
    ("soft_skills", "communication"), ("soft_skills", "to"), ("soft_skills", "that the"), ("soft_skills", "el"),
    ("soft_skills", "machine learning"), ("data_science", "machine learning"), ("data_science", "are"),
    ("data_science", "a/b testing"), ("data_science", "the and to"), ("data_science", "été"),
]
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "that", "for", "with", "on", "at", "as", "by",
    "der", "die", "und", "das", "les", "des", "que", "el", "los",
]
# expected terms per category; some are not in the dictionary, and src3 has no list
EXPECTED_TERMS = [
    (f"src{i}", term)
    for i in range(20) if i != 3
    for term in ["the", "python", "statistics", ["and", "of the", "mit", "sql", "with"][i % 5]]
]


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def _small(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    # VALUES, not an RDD: the optimizer then knows the size and decides on broadcasting by it
    body = _values(rows).replace("\\", "\\\\")
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def taxonomy(spark: SparkSession) -> DataFrame:
    return _small(spark, [(i, c, t) for i, (c, t) in enumerate(TAXONOMY)], ["ordinal", "category", "term"])


def expected_terms(spark: SparkSession) -> DataFrame:
    return _small(spark, EXPECTED_TERMS, ["category", "term"])


# Derived texts ----------------------------------------------------------------------

PROFILE_TOPS = [
    "JOHN DOE\nme@mail.example.com | +1 (555) 123-4567\n\nSUMMARY\nData Analyst with 3 years of experience in Python and SQL.\n",
    "  Contact\n  http://home.example.org/me?x=1 or a.b-c@d.example.org\n\n  About   me\nSenior Software Engineer, C++11 and C#,\tnode.js..\n",
    "Experienced people lead.\nB.S. in Computer Science\nEDUCATION\nBachelor's of Science in Data Analytics\nPh.D. Stanford University of Applied Thought\n",
    "",
    "professional experience\nVP of Data Platform (2019-2021)\nJan 2020 - Present\n● Built ASP.NET Core and .NET Core tools\n",
    "Profile: 10 yrs of experience\n\nWORK HISTORY\nJunior Data   Scientist / ML Engineer at Northern Institute\n03/2018 – 11/2020\n",
    "Skills: Python, SQL, Power BI\nSkills\nscikit-learn, CI/CD and A/B testing, machine learning\n",
]
PROFILE_BODIES = [
    "\nEDUCATION\nMaster of Science in Physics, University of Oslo\nMBA\n",
    "\nPROJECTS\n• Docker and docker again - data pipeline on Google Cloud\n* Tableau dash-board 2. second item in a list\n",
    "\nCertifications\nAWS Certified Solutions Architect, PMP\nCertified Scrum Master and Six Sigma Green Belt\n",
    "\nEmployment\nProject Manager, Head of Research and Plans\nEmployment\nResearch Scientist\n",
    "\n",
    "\nawards\nBest paper\nPublications\nA paper on Machine Learning\nLanguages\nGerman, French\n",
    "\nEDUCATION\nArden College, B.Tech\nEXPERIENCE\nBusiness   Intelligence Analyst...\nSKILLS\nPostgreSQL, PyTorch\n",
    "\nacademic record: GED, associate's of arts\nPortfolio\n12 months of experience, Full-Stack Developer\n",
]
PROFILE_ENDS = [
    "\nTeaching Assistant\n", "\\n tail Â â€™s \\r\\n", "", "\n\n\nskills\n", "\nMIS and Finance; Co-op intern.\n",
    "\nSeries 7, CompTIA Security+ analyst\n",
]
JOB_TOPS = [
    "Position: Data   Engineer\n", "Senior Data Analyst\nRole:  Lead\n", "  Business Analyst wanted  \n\n", "",
    "Title:\nSoftware Developer\n",
]
JOB_ENDS = [
    "\nRequirements:\n- 3+ years with Python and SQL\n- Proficiency in Tableau or Power BI\n\nNice to have:\n- AWS certification or Docker\n",
    "\nQUALIFICATIONS\n• well-known Google Cloud tools • PostgreSQL and scikit-learn\nPreferred\n1. Spark data pipeline 2) CI/CD know how\n",
    "\nmust have: C++11, machine learning experience\n",
    "\nBonus: PyTorch and communication * A/B testing background\n",
    "\n",
    "\nRequirement: node.js, .NET Core in asp.net core shops\nplus\nmit license\n",
]
FILE_ENDS = [".PDF", ".docx", ".doc", ".txt", ".text", ".csv", "", ".", ".tar.TXT"]


def pick(index: Column, options: list[str]) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(index, F.lit(len(options))).cast("int"))


def pick_sql(index: str, options: list[str]) -> str:
    items = ", ".join("'" + o.replace("'", "''") + "'" for o in options)
    return f"([{items}])[CAST(({index}) % {len(options)} AS INTEGER) + 1]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given documents, dealt out by id: each given file is one row group, which one task would read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category"), "lang", "text")
    return docs.repartition("doc_id")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    text = F.concat(pick(d, PROFILE_TOPS), F.col("text"), pick(F.floor(d / 7), PROFILE_BODIES),
                    pick(F.floor(d / 56), PROFILE_ENDS))
    return documents(spark, sf_dir).withColumn("text", text)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    text = F.concat(pick(i, JOB_TOPS), F.col("text"), pick(F.floor(i / 5), JOB_ENDS))
    return table(spark, sf_dir, "benchmark").select(i.alias("job_id"), text.alias("text"))


def job_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job texts by category; every second category has none."""
    return jobs(spark, sf_dir).select(F.concat(F.lit("src"), F.col("job_id") * 2).alias("category"), "job_id", "text")


SQL_TAXONOMY = (
    "taxonomy(ordinal, category, term) AS (SELECT * FROM (VALUES "
    + _values([(i, c, t) for i, (c, t) in enumerate(TAXONOMY)]) + ") t(a, b, c))"
)
SQL_TERMS = SQL_TAXONOMY + (
    ", terms AS (SELECT lower(term) AS term, arg_max(category, ordinal) AS category"
    " FROM taxonomy GROUP BY lower(term))"
)
SQL_STOP = "stops(word) AS (SELECT unnest([" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]))"
SQL_EXPECTED = "expected(category, term) AS (SELECT * FROM (VALUES " + _values(EXPECTED_TERMS) + ") t(a, b))"
SQL_PROFILES = (
    "profiles AS (SELECT doc_id, source AS category, lang, "
    + pick_sql("doc_id", PROFILE_TOPS) + " || text || " + pick_sql("doc_id // 7", PROFILE_BODIES)
    + " || " + pick_sql("doc_id // 56", PROFILE_ENDS) + " AS text FROM documents)"
)
SQL_JOBS = (
    "jobs AS (SELECT item_id AS job_id, " + pick_sql("item_id", JOB_TOPS) + " || text || "
    + pick_sql("item_id // 5", JOB_ENDS) + " AS text FROM benchmark)"
)
SQL_TEMPLATES = SQL_JOBS + ", templates AS (SELECT 'src' || (job_id * 2) AS category, job_id, text FROM jobs)"

# SQL's \b and \w know only ASCII. Letters and numbers beyond it become "_" and other
# characters beyond it "~", one for one, so offsets stay the same and "_" counts as a word
# character that no pattern names. The en dash is kept: the duration patterns name it.
SQL_ASCII = (
    r"regexp_replace(regexp_replace({0}, '[^\x00-\x7F\p{{L}}\p{{N}}–]', '~', 'g'), '[^\x00-\x7F–]', '_', 'g')"
)


def ascii_sql(expr: str) -> str:
    return SQL_ASCII.format(expr)


def hits_sql(texts: str, key: str, name: str) -> str:
    """First occurrence of each term by brute force, one regex per term and text."""
    return rf"""{name}_low AS MATERIALIZED (SELECT {key}, {ascii_sql('lower(text)')} AS low FROM {texts}),
  {name}_rx AS MATERIALIZED (SELECT term, category, '\b' || regexp_replace({ascii_sql('term')}, '([^A-Za-z0-9_])', '\\\1', 'g') || '\b' AS rx FROM terms),
  {name}_raw AS MATERIALIZED (SELECT {key}, term, category,
      CAST(length(regexp_extract(low, '(?s)^(.*?)' || rx, 1)) AS INTEGER) AS "start"
    FROM {name}_low, {name}_rx WHERE regexp_matches(low, rx)),
  {name} AS MATERIALIZED (SELECT {key}, term, category, "start", CAST("start" + length(term) AS INTEGER) AS "end" FROM {name}_raw)"""


# Spans as a tagger would give them: capitalised phrases, labelled in turn.
SPAN_PHRASE = r"[•-]?[A-Z][A-Za-z.]*(?: (?:of |and )?[A-Z][A-Za-z.]*)*"
# The same phrase for Java: nothing follows its repeats, so they need not give anything back, and
# a greedy repeat of a group takes stack for every word of a phrase.
JAVA_SPAN_PHRASE = SPAN_PHRASE.replace("*", "*+")
SPAN_LABELS = ["ORG", "GPE", "DATE", "PERSON"]


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = profiles(spark, sf_dir).select("doc_id", rx.cut_at_matches(F.translate("text", rx.MARK, " "), JAVA_SPAN_PHRASE).alias("pieces"))
    cut = offsets.with_bases(cut, "pieces")
    found = cut.select("*", F.posexplode_outer("pieces").alias("pos", "text")).filter("pos % 2 = 1")
    label = pick(F.floor(F.col("pos") / 2) + F.col("doc_id"), SPAN_LABELS)
    start = offsets.offset_of("pieces", F.col("pos"))
    return found.select("doc_id", label.alias("label"), "text", start.alias("start")).select(
        "doc_id", "label", "text", "start", (F.col("start") + F.char_length("text")).alias("end"))


def cuts_sql(texts: str, name: str, tables: dict[str, list[str]], key: str = "doc_id", as_ascii: bool = True,
             flags: str = "(?i)") -> str:
    """Every match of every pattern with its offset: ``key, label, rank, raw, start``.

    Offsets come from a running sum over the pieces between and in the matches.
    """
    rows = _values([(label, rank, flags + p) for label, ps in tables.items() for rank, p in enumerate(ps)])
    text = ascii_sql("text") if as_ascii else "text"
    return rf"""{name}_rx(label, rank, rx) AS (SELECT * FROM (VALUES {rows}) t(a, b, c)),
  {name}_txt AS MATERIALIZED (SELECT {key}, text, {text} AS t FROM {texts}),
  {name}_cut AS (SELECT {key}, label, rank, string_split(regexp_replace(t, rx, chr(1) || '\0' || chr(1), 'g'), chr(1)) AS ps
    FROM {name}_txt, {name}_rx WHERE regexp_matches(t, rx)),
  {name}_pcs AS (SELECT {key}, label, rank, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM {name}_cut),
  {name}_off AS (SELECT {key}, label, rank, p, i, CAST(sum(length(p)) OVER (PARTITION BY {key}, label, rank ORDER BY i) - length(p) AS INTEGER) AS "start"
    FROM {name}_pcs),
  {name} AS MATERIALIZED (SELECT o.{key}, label, CAST(rank AS INTEGER) AS rank, substring(text, "start" + 1, length(p)) AS raw, "start",
      CAST("start" + length(p) AS INTEGER) AS "end", i // 2 - 1 AS nth
    FROM {name}_off o JOIN {name}_txt t ON o.{key} = t.{key} WHERE i % 2 = 0)"""


SQL_SPANS = (
    cuts_sql("profiles", "phrases", {"x": [SPAN_PHRASE]}, as_ascii=False, flags="")
    + ", spans AS MATERIALIZED (SELECT doc_id, "
    + pick_sql('nth + doc_id', SPAN_LABELS) + ' AS label, raw AS text, "start", "end" FROM phrases)'
)
