r"""The patterns and thresholds that decide what is found.

Results depend on these exactly, so they are stated as they are. ``\w \s \d \b`` are
expanded to Unicode classes by ``fitmill.functions.regex.expand``. All entity and header
patterns ignore case. Every table is only a default: callers may pass their own.
"""

# Text normalisation
URL = r"http[s]?://\S+"
EMAIL = r"[\w.-]++@[\w.-]+\.\w+"
EMAIL_TAG = "[EMAIL]"
PHONE = r"[\+]?[(]?[0-9]{1,3}[)]?[-\s\.]?[(]?[0-9]{1,3}[)]?[-\s\.]?[0-9]{3,6}"
PHONE_TAG = "[PHONE]"
BULLET = "•"
BULLET_GLYPHS = "•●○■□▪▫◦‣⁃"
BULLET_SPLIT = r"[•●○■□▪▫◦‣⁃\-\*]|\d+[.)]\s"
ARTEFACTS = [("\\r\\n", " "), ("\\n", " "), ("Â", " "), ("â€™", "'"), ('â€"', "-")]

# Section headers at the start of a line, in order of priority. White space inside a
# header never crosses a line break.
LINE_HEADERS = {
    "contact": r"contact|personal\s+info|details",
    "summary": r"summary|objective|profile|about\s+me",
    "education": r"education|academic|qualification|degree",
    "experience": r"experience|employment|work\s+history|professional\s+experience",
    "skills": r"skills|technical\s+skills|competencies|technologies|expertise",
    "projects": r"projects|portfolio|work\s+samples|personal\s+projects",
    "certifications": r"certifications?|licenses?|credentials",
    "achievements": r"achievements?|accomplishments?|awards?",
    "publications": r"publications?|papers?|research",
    "languages": r"languages?|linguistic",
}
NO_HEADER = "other"

# Section headers anywhere in the text, and the least length of a section
SLICE_HEADERS = {
    "education": r"education|academic|qualification|degree",
    "experience": r"experience|employment|work\s+history|professional",
    "skills": r"skills|technical\s+skills|competencies|technologies",
    "projects": r"projects|portfolio|work\s+samples",
}
SLICE_MIN_CHARS = 50

# Parts of a job text
TITLE_LABEL = r"(?:position|title|role):\s*([^\n]+)"
REQUIREMENTS_BLOCK = r"(?:requirements?|qualifications?|must\s+have)[\s:]*(.+?)(?:nice\s+to\s+have|preferred|bonus|\z)"
NICE_BLOCK = r"(?:nice\s+to\s+have|preferred|bonus|plus)[\s:]*(.+?)\z"

DEGREES = [
    r"\b(Bachelor\'?s?|Master\'?s?|Doctorate|Doctor)\s+(?:of\s+)?(Science|Arts|Engineering|Business|Administration|Philosophy|Education|Fine Arts|Laws|Medicine)(?:\s+in\s+[\w\s]+)?\b",
    r"\b(Ph\.?D\.?|Doctor\s+of\s+Philosophy)\b",
    r"\b(M\.?D\.?|J\.?D\.?|Ed\.?D\.?|D\.?B\.?A\.?|Pharm\.?D\.?)\b",
    r"\b(MBA|MFA|MPA|MPH|MSW|LLM|LLB|MEng|MCS|MIS)\b",
    r"\b(B\.S\.?|B\.?S\.)\s*(?:in\s+[\w\s]+)?",
    r"\b(M\.S\.?|M\.?S\.)\s*(?:in\s+[\w\s]+)?",
    r"\b(B\.A\.?|B\.?A\.)\s*(?:in\s+[\w\s]+)?",
    r"\b(M\.A\.?|M\.?A\.)\s*(?:in\s+[\w\s]+)?",
    r"\b(B\.E\.?|B\.?E\.)\s*(?:in\s+[\w\s]+)?",
    r"\b(M\.E\.?|M\.?E\.)\s*(?:in\s+[\w\s]+)?",
    r"\bBachelor\s+of\s+Science\b",
    r"\bBachelor\s+of\s+Arts\b",
    r"\bMaster\s+of\s+Science\b",
    r"\bMaster\s+of\s+Arts\b",
    r"\bMaster\s+of\s+Business\s+Administration\b",
    r"\b(B\.?Tech\.?|M\.?Tech\.?)\b",
    r"\b(A\.?A\.?S?|A\.?S\.?|Associate\'?s?\s+(?:of\s+)?(?:Science|Arts|Applied\s+Science)?)\b",
    r"\b(High\s+School\s+Diploma|GED|Secondary\s+Education)\b",
]

CERTIFICATIONS = [
    r"\bAWS\s+Certified[\w\s-]*(?:Solutions\s+Architect|Developer|SysOps|DevOps|Machine\s+Learning|Data\s+Analytics|Cloud\s+Practitioner)?[\w\s-]*",
    r"\bAmazon\s+Web\s+Services\s+Certified[\w\s-]*",
    r"\bAzure\s+(?:Certified|Administrator|Developer|Solutions\s+Architect|Data\s+Engineer|AI\s+Engineer)[\w\s-]*",
    r"\bMicrosoft\s+Certified[\w\s-]*",
    r"\bGoogle\s+Cloud\s+(?:Certified|Professional)[\w\s-]*",
    r"\bGCP\s+(?:Certified|Professional)[\w\s-]*",
    r"\b(PMP|Project\s+Management\s+Professional)\b",
    r"\b(CAPM|Certified\s+Associate\s+in\s+Project\s+Management)\b",
    r"\b(CSM|Certified\s+Scrum\s+Master)\b",
    r"\b(PSM\s*[I1]?|Professional\s+Scrum\s+Master)\b",
    r"\bSAFe[\s\d]*(?:Agilist|Practitioner|Architect)?\b",
    r"\b(ITIL[\s\w]*(?:Foundation|Practitioner|Expert)?)\b",
    r"\b(CISSP|Certified\s+Information\s+Systems\s+Security\s+Professional)\b",
    r"\b(CISM|Certified\s+Information\s+Security\s+Manager)\b",
    r"\b(CEH|Certified\s+Ethical\s+Hacker)\b",
    r"\bCompTIA[\s\w+-]*(?:A\+|Network\+|Security\+|Cloud\+|Data\+|Linux\+)?\b",
    r"\bTableau[\s\w]*(?:Desktop|Server)?\s*Certified[\w\s]*",
    r"\bCertified\s+(?:Data\s+)?(?:Analyst|Scientist|Engineer)[\w\s]*",
    r"\b(CPA|Certified\s+Public\s+Accountant)\b",
    r"\b(CFA|Chartered\s+Financial\s+Analyst)\b",
    r"\b(CFP|Certified\s+Financial\s+Planner)\b",
    r"\bSeries\s+\d+\b",
    r"\b(?:Lean\s+)?Six\s+Sigma[\s\w]*(?:Green|Black|Yellow|White)\s*Belt\b",
    r"\b(?:Green|Black|Yellow|White)\s*Belt(?:\s+Certified)?\b",
    r"\bCertified\s+[\w\s]+(?:Professional|Specialist|Expert|Administrator|Developer|Engineer|Analyst)\b",
]

JOB_TITLES = [
    r"\b(Senior|Junior|Lead|Principal|Staff|Associate)?\s*(Data)\s+(Scientist|Analyst|Engineer|Architect)\b",
    r"\b(Business\s+Intelligence|BI)\s+(Analyst|Developer|Engineer)\b",
    r"\b(Machine\s+Learning|ML|AI)\s+(Engineer|Scientist|Researcher)\b",
    r"\b(Data)\s+(Science|Analytics)\s+(Manager|Director|Lead)\b",
    r"\b(Senior|Junior|Lead|Principal|Staff)?\s*(Software|Backend|Frontend|Full[\s-]?Stack)\s+(Engineer|Developer)\b",
    r"\b(DevOps|SRE|Platform|Infrastructure)\s+(Engineer|Architect)\b",
    r"\b(QA|Quality\s+Assurance|Test)\s+(Engineer|Analyst|Lead)\b",
    r"\b(Engineering|Product|Project|Program)\s+(Manager|Director|Lead)\b",
    r"\b(VP|Vice\s+President|Director|Head)\s+of\s+[\w\s]+\b",
    r"\b(CTO|CEO|CFO|CIO|COO|Chief[\w\s]+Officer)\b",
    r"\b(Research)\s+(Scientist|Engineer|Assistant)\b",
    r"\b(Solutions?)\s+(Architect|Engineer|Consultant)\b",
    r"\b(Technical)\s+(Lead|Architect|Writer|Consultant)\b",
    r"\b(Consultant|Analyst|Specialist|Coordinator|Administrator)\b",
    r"\b(Intern|Internship|Co-op|Trainee)\b",
]

DURATIONS = [
    r"\b(\d{1,2}/\d{4})\s*[-–]\s*(Present|\d{1,2}/\d{4})\b",
    r"\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{4}\s*[-–]\s*(Present|(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{4})\b",
    r"\b\d{4}\s*[-–]\s*(Present|\d{4})\b",
    r"\b(\d+)\s*(years?|months?|yrs?|mos?)\s*(of\s+experience)?\b",
]

FIELDS_OF_STUDY = [
    r"\b(Computer\s+Science|Information\s+Technology|Software\s+Engineering)\b",
    r"\b(Data\s+Science|Data\s+Analytics|Business\s+Analytics)\b",
    r"\b(Electrical\s+Engineering|Mechanical\s+Engineering|Civil\s+Engineering)\b",
    r"\b(Mathematics|Statistics|Physics|Chemistry|Biology)\b",
    r"\b(Economics|Finance|Accounting|Business\s+Administration)\b",
    r"\b(Psychology|Sociology|Political\s+Science)\b",
    r"\b(Information\s+Systems|Management\s+Information\s+Systems|MIS)\b",
    r"\b(Artificial\s+Intelligence|Machine\s+Learning)\b",
]

# label -> ordered patterns; a pattern's place in its list is its rank
ENTITY_PATTERNS = {
    "DEGREE": DEGREES,
    "CERTIFICATION": CERTIFICATIONS,
    "JOB_TITLE": JOB_TITLES,
    "DURATION": DURATIONS,
    "FIELD_OF_STUDY": FIELDS_OF_STUDY,
}

INSTITUTION = r"(?:[\w\s]+)?(?:University|College|Institute|School|Academy)(?:\s+of\s+[\w\s]+)?"
INSTITUTION_NOUNS = ["university", "college", "institute", "school", "academy"]
INSTITUTION_MIN_CHARS = 5

# Plain string lists; group 1 is the value
EDUCATION_STRINGS = [
    r"\b(Ph\.?D\.?|Doctor\s+of\s+Philosophy)\b",
    r"\b(M\.?S\.?|Master\'?s?\s+of\s+Science)\b",
    r"\b(B\.?S\.?|Bachelor\'?s?\s+of\s+Science)\b",
    r"\b(M\.?A\.?|Master\'?s?\s+of\s+Arts)\b",
    r"\b(B\.?A\.?|Bachelor\'?s?\s+of\s+Arts)\b",
    r"\b(MBA|Master\s+of\s+Business\s+Administration)\b",
    r"\b(\w+\s+University)\b",
    r"\b(University\s+of\s+\w+)\b",
    r"\b(\w+\s+College)\b",
    r"\b(\w+\s+Institute)\b",
]
TITLE_STRINGS = [
    r"\b((?:Senior|Junior|Lead|Principal|Staff|Associate)?\s*Data\s+(?:Analyst|Scientist|Engineer))\b",
    r"\b((?:Senior|Junior|Lead)?\s*Business\s+(?:Analyst|Intelligence\s+Analyst))\b",
    r"\b((?:Senior|Junior|Lead|Principal|Staff)?\s*Software\s+(?:Engineer|Developer))\b",
    r"\b((?:Senior|Junior|Lead)?\s*Machine\s+Learning\s+Engineer)\b",
    r"\b((?:Senior|Junior|Lead)?\s*ML\s+Engineer)\b",
    r"\b((?:Senior|Junior)?\s*(?:Frontend|Backend|Full[\s-]?Stack)\s+(?:Engineer|Developer))\b",
    r"\b((?:Senior|Junior)?\s*DevOps\s+Engineer)\b",
    r"\b((?:Senior|Junior)?\s*Research\s+Scientist)\b",
    r"\b(Teaching\s+Assistant)\b",
    r"\b((?:Project|Product|Program)\s+Manager)\b",
]
