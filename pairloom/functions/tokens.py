"""Token tables of the normaliser. All entries are fixed values: results depend on them."""

# Legal form words and their canonical form.
LEGAL_FORMS = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co",
    "llc": "llc", "llp": "llp", "lp": "lp", "ltd": "ltd", "limited": "ltd", "pvt": "pvt", "private": "pvt",
    "plc": "plc", "pllc": "pllc", "pc": "pc", "opc": "opc",
    "sarl": "sarl", "sas": "sas", "sasu": "sasu", "sa": "sa", "eurl": "eurl", "snc": "snc", "sci": "sci", "scop": "scop", "selarl": "selarl",
    "gmbh": "gmbh", "ag": "ag", "bv": "bv", "nv": "nv",
}

# Words that carry no name.
FILLER = ["the", "and", "of", "dba", "www", "com", "shri", "sri", "dr", "m", "s"]

# Address words and their canonical form.
ADDRESS_CANON = {
    "street": "st", "str": "st", "avenue": "ave", "av": "ave", "avn": "ave", "boulevard": "blvd", "bd": "blvd", "boul": "blvd",
    "road": "rd", "drive": "dr", "lane": "ln", "court": "ct", "circle": "cir", "place": "pl", "square": "sq", "highway": "hwy",
    "parkway": "pkwy", "trail": "trl", "extension": "ext", "apartment": "apt", "appartement": "apt", "suite": "ste",
    "building": "bldg", "floor": "fl", "flr": "fl", "north": "n", "south": "s", "east": "e", "west": "w", "mount": "mt",
    "saint": "st", "sainte": "ste", "fort": "ft", "point": "pt", "township": "twp", "county": "cnty", "number": "no", "nos": "no",
    "r": "rue", "rue": "rue", "allee": "all", "impasse": "imp", "chemin": "chem", "route": "rte", "faubourg": "fbg", "quai": "qu",
    "residence": "res", "near": "nr", "opposite": "opp", "opposit": "opp", "behind": "bh", "nagar": "ngr", "marg": "marg",
    "colony": "col", "sector": "sec", "village": "vil", "post": "po", "district": "dist", "dist": "dist",
}

# Address words that are dropped, after the table above was applied.
ADDRESS_DROP = ["null", "na", "n", "a", "unit", "the", "of", "de", "du", "des", "la", "le", "les"]

# Scripts that mark a name as not Latin.
SCRIPTS = ["Devanagari", "Tamil", "Telugu", "Gurmukhi", "Bengali", "Gujarati", "Kannada", "Malayalam", "Oriya", "Arabic", "Cyrillic", "Han"]

# Digits that stand for letters inside a word.
LEET_FROM, LEET_TO = "01345678", "oieasgtb"
