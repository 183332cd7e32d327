"""Fixed values of title classification: word lists and patterns, matched on lower-cased titles.

Patterns keep to what Java's, Python's and RE2's regular expressions share.
"""

#: First match wins.
BUCKETS = ("black", "africana", "mena", "african", "minority", "ethnic", "race")

OVERRIDES = (
    (r"\bafrican\s*,?\s*black\s+and\s+caribbean\s+studies\b", "black"),
    (r"\bafrican\s+and\s+african[-\s]?american\s+studies\b", "black"),
    (r"\brace\s+and\s+ethnic\s+studies\b", "race"),
)

BUCKET_PATTERNS = {
    "black": (
        r"\bafrican[-\s]?american\b",
        r"\bafro[-\s]?american\b",
        r"\bblack\s+studies\b",
        r"\bblack\s+(american|diaspora|diasporic)\b",
        r"\bafrican\s*,?\s*black\b",
        r"\bafrican\s*,?\s*black\s+and\s+caribbean\s+studies\b(?:\s+(?:program|department|major|minor|certificate|center|centre))?",
        r"\bblack\s+and\s+.*\bstudies\b",
        r"\bcritical\s+black\s+studies\b",
        r"\bafrican\s+and\s+african[-\s]+american\s+studies\b",
        r"\bafrican\s+and\s+african\s+american\s+studies\b",
        r"\bblack\s+visual\s+cultures\b",
    ),
    "africana": (
        r"\bafricana\b",
        r"\bpan[-\s]?african\b",
        r"\bafricolog\w*\b",
    ),
    "mena": (
        r"\bmiddle\s+east\b",
        r"\bmiddle\s+eastern\b",
        r"\bnorth\s+africa\b",
        r"\bnorth\s+african\b",
        r"\bnear\s+east\b",
        r"\bnear\s+eastern\b",
        r"\bmena\b",
        r"\bmiddle\s+eastern\s+and\s+north\s+african\s+studies\b",
        r"\bmiddle\s+eastern\s+and\s+north\s+africa\s+studies\b",
        r"\bmiddle\s+east\s+and\s+north\s+africa\s+studies\b",
        r"\bmiddle\s+east\s+and\s+north\s+african\s+studies\b",
        r"\bmiddle\s+eastern\s*,\s*central\s+asian\s*,\s*and\s+north\s+african\s+studies\b",
    ),
    "african": (
        r"\bafrican\s+studies\b",
        r"\bafrican\s+and\s+african\s+diaspora\s+studies\b",
        r"\bafrican\s+and\s+african\s+diasporic\s+studies\b",
        r"\bafrican\s+diaspora\s+studies\b",
        r"\bafrican\s+languages?\b",
        r"\bafrican\s+literatures?\b",
        r"\bafrican\s+language\s+program\b",
        r"\bafrica\b",
    ),
    "minority": (
        r"\bminority\b",
        r"\bcultural\s+minority\b",
    ),
    "race": (
        r"\brace\b",
        r"\bracial\b",
        r"\bcritical\s+race\b",
        r"\bracial\s+justice\b",
        r"\brace\s*,?\s*power\b",
    ),
    "ethnic": (
        r"\brace\s*,?\s*ethnicity\b",
        r"\brace\s+and\s+ethnicity\b",
        r"\bethnic\b",
        r"\bethnicity\b",
    ),
}

MENA_TERMS = ("middle east", "middle eastern", "north africa", "north african", "mena", "near east", "near eastern", "central asian", "central asia")
FALSE_POSITIVES = ("black belt", "blackstone", "blackboard", "black history month", "black student union")
ANCHOR_PHRASES = ("ethnic studies", "black studies", "africana studies", "african studies", "african and african american studies")
ANCHOR_TITLES = ("Black Studies", "Africana Studies", "African Studies", "Ethnic Studies", "African and African American Studies", "African-American/Black Studies")
PROGRAM_TOKENS = ("major", "minor", "department", "program", "concentration", "certificate", "b.a", "ba", "b.s", "bs", "m.a", "ma", "m.s", "ms", "phd", "doctorate", "degree")
JUNK_PHRASES = (
    "welcome", "about", "view", "check out", "read more", "learn more", "connect with", "visit", "calendar", "faculty", "staff", "donate", "newsletter", "timeline",
    "annual report", "events", "news", "image", "photo", "video", "lecture series", "launchpad", "symposium", "workshop", "financial aid", "scholarship", "fellowship", "career map",
)
COURSE_PHRASES = (
    "introduction to", "intro to", "critical debates", "seminar", "special topics", "research in", "4-year plan", "transfer plan", "curriculum", "requirements", "electives",
    "prerequisite", "prerequisites", "prereq",
)
TRIP_VERBS = ("experience", "travel", "study abroad", "healing", "healthcare", "reads into", "honoring")
COUNTRIES = ("ghana", "south africa", "nigeria", "kenya", "ethiopia", "uganda", "tanzania", "rwanda")
CENTERS = ("center", "centre", "institute", "initiative", "lab", "laboratory", "research center", "research centre")
COMMITTEES = ("committee", "council", "office", "division", "board")

YEAR = r"\b(19|20)\d{2}([-/]\d{2})?\b"
CLASS_YEAR = "\\b['\u2019]\\d{2}\\b"
DESCRIPTOR = r"\b(financial\s+aid|scholarship|fellowship|career\s+map)\b"
STRONG_TOKEN = r"\b(major|minor|department|program|certificate|concentration|degree)\b"
DEGREE_TOKEN = r"\b(b\.?a\.?|b\.?s\.?|m\.?a\.?|m\.?s\.?|ph\.?d\.?)\b"
DEGREE_PHRASE = r"\b(ba|bs|b\.a\.|b\.s\.|ma|ms|m\.a\.|m\.s\.|phd|ph\.d\.)\s+in\b|\bbachelor\s+of\s+(arts|science)\s+in\b|\bmaster\s+of\s+(arts|science)\s+in\b"
MAJOR_MINOR = r"\(\s*m\s*,\s*m\s*\)"
BARE_STUDIES = r"\bstudies\b$"
ADMIN = (
    r"\b(curriculum|requirements|electives|4-year\s+plan|transfer\s+plan|catalog|degree\s+type|research\s+guide|guide|prereq(?:uisite)?s?|open\s+to\s+students|have\s+declared|program\s+of\s+study|senior\s+priority)\b"
)
STORY = r"\b(reads\s+into|named|talking\s+with|studying|honoring|why\b)\b|\?"
PROFILE_DASH = r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b\s*[-–—]\s*"  # on the title as it is
DASH_SUFFIX = r"[-–—]\s*(major|minor|certificate|concentration)\b"
COURSE_PREFIX = r"^(introduction|intro|seminar|topics|special\s+topics|survey|advanced|capstone|independent\s+study|practicum|critical\s+debates|research|research\s+in)\b"
CV_TAXONOMY = r"^ethnic\s*,\s*cultural\s+minority\s*,\s*and\s+gender\s+studies\s*,\s*other\b"
COURSE_NUMBER = r"\b\d{3,4}\b"

NAVIGATION_PREFIX = r"^\s*(academic\s+departments\s+and\s+programs|majors\s+and\s+minors|majors|minors|programs)\b[:\s-]*"
PAGE_PREFIX = r"^\s*(check\s+out|view|welcome\s+to|about)\b[:\s-]*"
TRACK = r"\s*\(([^)]{2,120})\)\s*$"
DEGREE_PREFIXES = (
    r"^\s*(ba|bs|b\.a\.|b\.s\.|ma|ms|m\.a\.|m\.s\.|phd|ph\.d\.)\s+in\s+",
    r"^\s*bachelor\s+of\s+(arts|science)\s+in\s+",
    r"^\s*master\s+of\s+(arts|science)\s+in\s+",
)
UNIT_PREFIXES = (r"^\s*department\s+of\s+", r"^\s*the\s+department\s+of\s+", r"^\s*the\s+")
LEVEL_SUFFIXES = (r"\s+\bmajor\s+and\s+minor(s)?\b$", r"\s+\b(major|minor|program)\b$")
#: Labels that a title of several subjects becomes, by the first phrase it holds; "African Studies" only without these.
COMBINED = ("Ethnic Studies", "Black Studies", "Africana Studies", "African and African American Studies", "African Studies")
NOT_AFRICAN = ("african american", "african-american")
CARIBBEAN = r"\bafrican\s*,\s*black\s+and\s+caribbean\s+studies\b"

#: Kinds that are real but no programs.
SIGNAL_KINDS = ("center_institute", "committee_admin", "department_unit", "program_signal")
