"""Word lists, patterns and codes that results depend on.

Nothing here is logic. Every list can be replaced through a parameter of the function using it.
"""

# Skill token -> canonical skill. Looked up one token at a time, so keys with a space never match.
SKILL_SYNONYMS = {
    "js": "javascript",
    "node": "nodejs",
    "node.js": "nodejs",
    "react.js": "reactjs",
    "reactjs": "reactjs",
    "vue.js": "vuejs",
    "angular.js": "angularjs",
    "express.js": "expressjs",
    "ml": "machine learning",
    "ai": "artificial intelligence",
    "dl": "deep learning",
    "nlp": "natural language processing",
    "cv": "computer vision",
    "aws": "amazon web services",
    "gcp": "google cloud platform",
    "k8s": "kubernetes",
    "docker": "docker",
    "tf": "tensorflow",
    "py": "python",
    "cpp": "cplusplus",
    "c++": "cplusplus",
    "c#": "csharp",
    "vb": "visual basic",
    "vb.net": "visual basic",
    "postgres": "postgresql",
    "mongo": "mongodb",
    "mssql": "sql server",
    "ms sql": "sql server",
    "mysql": "mysql",
    "nosql": "nosql",
    "oop": "object oriented programming",
    "ci/cd": "cicd",
    "ci cd": "cicd",
    "rest": "rest api",
    "restful": "rest api",
    "api": "api",
    "html5": "html",
    "css3": "css",
    "sass": "css",
    "scss": "css",
    "jquery": "jquery",
    "typescript": "typescript",
    "ts": "typescript",
    "golang": "go",
    "ms office": "microsoft office",
    "ms excel": "excel",
    "powerpoint": "powerpoint",
    "ppt": "powerpoint",
    "photoshop": "adobe photoshop",
    "illustrator": "adobe illustrator",
    "r programming": "r",
    "sas": "sas",
    "spss": "spss",
    "matlab": "matlab",
    "tableau": "tableau",
    "power bi": "powerbi",
    "linux": "linux",
    "unix": "unix",
    "windows": "windows",
    "macos": "macos",
    "ios": "ios",
    "android": "android",
    "swift": "swift",
    "kotlin": "kotlin",
    "ruby on rails": "ruby on rails",
    "ror": "ruby on rails",
    "django": "django",
    "flask": "flask",
    "spring": "spring framework",
    "spring boot": "spring boot",
    ".net": "dotnet",
    "asp.net": "dotnet",
    "scala": "scala",
    "hadoop": "hadoop",
    "spark": "apache spark",
    "pyspark": "apache spark",
    "hive": "apache hive",
    "kafka": "apache kafka",
    "etl": "etl",
    "git": "git",
    "svn": "subversion",
    "jira": "jira",
    "agile": "agile",
    "scrum": "scrum",
    "devops": "devops",
    "qa": "quality assurance",
    "qc": "quality control",
    "ui": "user interface",
    "ux": "user experience",
    "ui/ux": "ui ux design",
    "seo": "search engine optimization",
    "sem": "search engine marketing",
    "crm": "customer relationship management",
    "erp": "enterprise resource planning",
    "sap": "sap",
}

# Words in a section title, by category; the first category with a hit wins.
SECTION_KEYWORDS = {
    "skills": [
        "skills", "technical skills", "core competencies", "competencies", "expertise", "highlights",
        "qualifications summary", "areas of expertise", "technical proficiencies", "proficiencies",
        "technologies",
    ],
    "experience": [
        "experience", "work experience", "employment", "work history", "professional experience",
        "employment history", "professional background", "accomplishments", "professional summary",
        "summary",
    ],
    "education": [
        "education", "academic", "qualifications", "certifications", "certification", "training",
        "academic background", "licenses", "education and training", "credentials",
    ],
}

# Case-sensitive marks in a section id, in order, for sections without a title element.
SECTION_ID_MARKS = [
    ("NAME", "other"),
    ("EXPR", "experience"),
    ("SUMM", "experience"),
    ("HILT", "skills"),
    ("SKLL", "skills"),
    ("EDUC", "education"),
    ("CERT", "education"),
]

SECTION_CATEGORIES = ["skills", "experience", "education", "other"]

# Degree patterns on lower-cased text, in order; the first match wins.
DEGREE_PATTERNS = [
    (r"\b(?:ph\.?d|doctorate|doctoral)\b", "phd"),
    (r"\b(?:master(?:\'?s)?|m\.?s\.?|m\.?a\.?|mba|m\.?eng)\b", "masters"),
    (r"\b(?:bachelor(?:\'?s)?|b\.?s\.?|b\.?a\.?|b\.?eng|b\.?tech)\b", "bachelors"),
    (r"\b(?:associate(?:\'?s)?|a\.?s\.?|a\.?a\.?)\b", "associates"),
    (r"\b(?:diploma|certificate|certification)\b", "diploma"),
    (r"\b(?:high school|ged|secondary)\b", "high_school"),
]

DEGREE_CODES = {
    "unknown": 0,
    "high_school": 1,
    "diploma": 2,
    "associates": 3,
    "bachelors": 4,
    "masters": 5,
    "phd": 6,
}

# Years-of-experience patterns on lower-cased text; group 1 is the number.
YEARS_PATTERNS = [
    r"(\d+)\+?\s*(?:years?|yrs?)\s*(?:of)?\s*(?:experience|exp)",
    r"(?:over|more than|nearly|approximately|about)\s*(\d+)\s*(?:years?|yrs?)",
    r"(\d+)\+?\s*(?:years?|yrs?)\s*(?:in|of|working)",
]

# Seniority patterns on lower-cased text, in order; the first match wins, none is 0.
SENIORITY_PATTERNS = [
    (r"\b(vp|vice\s*president|c[eo]o|cto|cfo)\b", 7),
    (r"\b(director)\b", 6),
    (r"\b(manager|management)\b", 5),
    (r"\b(lead|principal|staff)\b", 4),
    (r"\b(senior|sr\.?)\b", 3),
    (r"\b(associate|mid[- ]level)\b", 2),
    (r"\b(junior|jr\.?|entry[- ]level)\b", 1),
    (r"\b(intern|trainee|apprentice)\b", 0),
]

# Header spellings, trimmed and lower-cased -> canonical column.
HEADER_ALIASES = {
    "resume_str": "Resume_str",
    "resume_string": "Resume_str",
    "resume_text": "Resume_str",
    "resume_html": "Resume_html",
    "category": "Category",
    "id": "ID",
}

# English function words removed from token lists.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Plural nouns that no suffix rule covers.
IRREGULAR_NOUNS = {
    "men": "man",
    "women": "woman",
    "salesmen": "salesman",
    "children": "child",
    "people": "people",
    "analyses": "analysis",
    "criteria": "criterion",
    "matrices": "matrix",
    "indices": "index",
    "lives": "life",
    "wives": "wife",
    "knives": "knife",
    "shelves": "shelf",
    "halves": "half",
    "acoustics": "acoustics",
    "aerodynamics": "aerodynamics",
    "always": "always",
    "analytics": "analytics",
    "athletics": "athletics",
    "atlas": "atlas",
    "bias": "bias",
    "canvas": "canvas",
    "christmas": "christmas",
    "dynamics": "dynamics",
    "economics": "economics",
    "electronics": "electronics",
    "ergonomics": "ergonomics",
    "genetics": "genetics",
    "gymnastics": "gymnastics",
    "kansas": "kansas",
    "lens": "lens",
    "linguistics": "linguistics",
    "logistics": "logistics",
    "mathematics": "mathematics",
    "news": "news",
    "obstetrics": "obstetrics",
    "orthopedics": "orthopedics",
    "pediatrics": "pediatrics",
    "perhaps": "perhaps",
    "physics": "physics",
    "politics": "politics",
    "robotics": "robotics",
    "series": "series",
    "species": "species",
    "texas": "texas",
    "thermodynamics": "thermodynamics",
    "whereas": "whereas",
    "calories": "calorie",
    "cookies": "cookie",
    "movies": "movie",
    "rookies": "rookie",
    "selfies": "selfie",
    "zombies": "zombie",
    "biases": "bias",
    "bonuses": "bonus",
    "buses": "bus",
    "campuses": "campus",
    "canvases": "canvas",
    "gases": "gas",
    "statuses": "status",
    "viruses": "virus",
}
