"""Stop-lists, confidences, weights and sentence templates.

Results depend on these exactly, so they are stated as they are. The term dictionary, the
expected terms and the job texts per category are larger and belong to the user: they are
always input tables.
"""

# label -> key of the plain record
RECORD_KEYS = {
    "SKILL": "skills",
    "DEGREE": "degrees",
    "INSTITUTION": "institutions",
    "FIELD_OF_STUDY": "fields_of_study",
    "JOB_TITLE": "job_titles",
    "COMPANY": "companies",
    "DURATION": "durations",
    "CERTIFICATION": "certifications",
    "LOCATION": "locations",
    "DATE": "dates",
}
# label -> key of the older record
COMPAT_KEYS = {
    "COMPANY": "organizations",
    "LOCATION": "locations",
    "DATE": "dates",
    "DEGREE": "degrees",
    "JOB_TITLE": "job_titles",
    "INSTITUTION": "institutions",
    "CERTIFICATION": "certifications",
}

TERM_CONFIDENCE = 1.0
PATTERN_CONFIDENCE = 0.9
SPAN_CONFIDENCE = 0.8
INSTITUTION_SPAN_CONFIDENCE = 0.85

# Labels that gain confidence when the text comes from the named section
BOOST = 0.1
SECTION_BOOSTS = [
    ("education", "DEGREE"), ("education", "INSTITUTION"),
    ("experience", "JOB_TITLE"), ("experience", "COMPANY"),
    ("skills", "SKILL"),
]

# Organisation names that are none, besides the dictionary terms
ORG_STOP = [
    "gpa", "bc", "ca", "ny", "present", "current",
    "data analytics engineering", "computer science", "data science",
    "machine learning", "artificial intelligence", "business administration",
    "b.s.", "m.s.", "ph.d.", "mba", "b.a.", "m.a.",
    "bachelor", "master", "doctorate", "degree",
    "experience", "education", "skills", "projects", "summary",
    "responsibilities", "achievements", "certifications",
]
ORG_EXCLUDED_PARTS = [
    "university", "college", "institute", "school", "academy",
    "b.s", "m.s", "ph.d", "mba", "bachelor", "master",
    "created", "built", "developed", "analyzed", "reduced", "increased",
    "statistics", "science", "engineering", "analytics",
]
ORG_CHARS = (2, 50)
SKIPPED_FIRST_CHARS = ["•", "-"]

# Places and dates that are none, besides the dictionary terms
PLACE_STOP = [
    "gpa", "bc", "ca", "ny", "tx", "wa", "ma",
    "m.s.", "b.s.", "b.a.", "m.a.", "ph.d.", "mba",
    "present", "current",
]
PLACE_MIN_CHARS = 3

# The shorter stop-list of the plain lists
PLAIN_STOP = [
    "gpa", "bc", "ca", "ny", "present", "current",
    "data analytics engineering", "computer science", "data science",
    "b.s.", "m.s.", "ph.d.", "mba", "bachelor", "master",
    "experience", "education", "skills", "projects", "summary",
]
PLAIN_EXCLUDED_PARTS = ["university", "college", "institute", "school"]

# Score
SEMANTIC_WEIGHT = 0.3
TERM_WEIGHT = 0.7
STRONG_FROM = 70.0
MODERATE_FROM = 40.0
MAX_FEATURES = 500

# Feedback
FIT_SENTENCES = {
    "Strong": "Your profile shows strong alignment with this position.",
    "Moderate": "You have a solid foundation for this role with some areas to develop.",
    "Weak": "This role may require significant skill development.",
}
PRIORITY_CATEGORIES = [
    "programming_languages", "cloud_platforms", "databases",
    "ml_ai_frameworks", "big_data", "devops_tools",
]
TECHNICAL_CATEGORIES = [
    "programming_languages", "ml_ai_frameworks", "data_science", "databases",
    "cloud_platforms", "big_data", "devops_tools", "visualization",
    "web_frameworks", "frontend", "data_tools", "testing",
]
NO_MATCH_INTRO = "Unable to generate cover letter snippet - no matched skills found."
DEFAULT_TITLE = "Position"
UNKNOWN_CATEGORY = "other"
