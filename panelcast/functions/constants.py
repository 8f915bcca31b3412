"""Domain constants.

FIXED VALUES: the lists below must equal the domain definitions exactly for
results to agree (names of control measures, priority diseases, taxa, the
taxa merges, and the text replacements of the name cleaner).  They are
stated plainly, in their natural order.
"""

# --- fixed values -----------------------------------------------------------
CONTROL_MEASURES = [
    "general surveillance",
    "ante and post-mortem inspections",
    "process to inactivate the pathogenic agent in products or by-products",
    "movement control inside the country",
    "precautions at the borders",
    "stamping out",
    "treatment",
    "modified stamping out",
    "screening",
    "official vaccination",
    "monitoring",
    "targeted surveillance",
    "disease notification",
    "control of wildlife reservoirs",
    "zoning",
    "control of vectors",
    "vaccination prohibited",
]

PRIORITY_DISEASES = [
    "foot_and_mouth_disease",
    "vesicular_stomatitis",
    "swine_vesicular_disease",
    "rinderpest",
    "peste_des_petits_ruminants",
    "ovine_bluetongue_disease",
    "lumpy_skin_disease",
    "rift_valley_fever",
    "african_horse_sickness",
    "african_swine_fever",
    "classical_swine_fever",
    "highly_pathogenic_avian_influenza",
    "newcastle_disease",
    "pleuropneumonia",
    "ovine_pox_disease",
]

TAXA_LIST = [
    "sheep/goats",
    "cattle",
    "birds",
    "camelidae",
    "dogs",
    "equidae",
    "cats",
    "cervidae",
    "swine",
    "buffaloes",
    "hares/rabbits",
]
TAXA_DROP = ["cats", "dogs", "cervidae"]
TAXA_SUFFIXES = [" (mixed herd)", " (mixed group)"]
TAXA_MERGE = {
    "goats": "sheep/goats",
    "sheep": "sheep/goats",
    "rabbits": "hares/rabbits",
    "hares": "hares/rabbits",
}

# status values and their precedence when several rows share one cell
STATUS_PRESENT = "present"
STATUS_ABSENT = "absent"
STATUS_UNREPORTED = "unreported"

# name cleaner replacements applied before snake-casing
CLEAN_NAME_REPLACEMENTS = [("'", ""), ('"', ""), ("%", "_percent_"), ("#", "_number_")]

CONTROL_SEPARATOR = "; "
RARE_DISEASE_LABEL = "rare_disease"
# --- end of fixed values ----------------------------------------------------

NOWCAST_KEY = [
    "country_iso3c",
    "report_year",
    "report_semester",
    "disease",
    "disease_population",
    "taxa",
]
NOWCAST_SERIES = ["country_iso3c", "disease", "disease_population", "taxa"]
NETWORK_KEY = ["country_iso3c", "disease", "month"]
