"""Small texts that hold the awkward cases."""

TEXTS = [
    "",
    "   \n\t ",
    "JOHN\nme.b-c@mail.example.com-x@y.org | +1 (555) 123-4567 http://a.b/c?d=1 https://x\n\nSUMMARY\nData Analyst, 3 years of experience.",
    "  Contact\n  About   me\nSenior  Software Engineer, C++11, c++ and C#,\tASP.NET Core... .net core",
    "Experienced people\nEDUCATION\nBachelor's of Science in Data Analytics\nPh.D. B.S. in Physics, M.S. MBA as md AS",
    "professional experience\nVP of Data Platform (2019-2021) 2019 - 2021-2022\nJan 2020 - Present\n03/2018 – 11/2020\n● Built things",
    "Skills: Python\nSkills\nscikit-learn, CI/CD and A/B testing, machine learning; Machine\nLearning, machine  learning",
    "Stanford University of Applied Thought. Preschools. The Old College\nof Arts and Letters, academy",
    "été ÉTÉ cafés café MIT İstanbul ıſ ſql Straße Kelvin-K naïve² ½ x",
    "AWS Certified Solutions Architect, PMP\nCertified Scrum Master and Six Sigma Green Belt; CompTIA Security+ Series 7",
    "emoji 😀 Data Scientist 😀😀 data   engineer, Lead Data Analyst Intern x",
    "education" + "x" * 45 + "skills and projects experience",
    "projects " + "y" * 39 + "\nskills work   history professional experience education",
    "a-b * item one is long enough 1. second item here 2) third item here • tiny – dash",
    "python python c r go the and of the of  the of the",
    "Role:  \nnext", "Position: Data Engineer\nRequirements: nice to have: A well known tool - Another tool here",
    "\n\n first line \nTitle:\n\nFoo bar\nMUST HAVE\n- Python skills needed\nPreferred:\n1. Spark experience here\n",
    "x.y.z.. a...b . . c\x0b\x0cd\x1cEXPERIENCE\x85research papers",
]

TAXONOMY = [
    ("lang", "Python"), ("lang", "c++"), ("lang", "c#"), ("lang", "c"), ("lang", "r"), ("lang", "sql"),
    ("web", ".net core"), ("web", "node.js"), ("ai", "machine learning"), ("ai", "scikit-learn"), ("ops", "ci/cd"),
    ("ops", "a/b testing"), ("words", "of the"), ("words", "été"), ("words", "café"), ("late", "sql"), ("words", "k"),
    ("words", "x"), ("ai", "data"), ("ai", "data analyst"), ("words", "the of the"),
]


def texts(spark, rows=None):
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def taxonomy(spark):
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(TAXONOMY)], "ordinal int, category string, term string")
