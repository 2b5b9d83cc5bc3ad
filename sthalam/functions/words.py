"""Word lists and weights that results depend on (fixed values)."""

ABBREVIATIONS = {
    "RD": "ROAD", "RDS": "ROAD", "MN": "MAIN", "CRS": "CROSS", "CRSS": "CROSS", "CR": "CROSS", "LYT": "LAYOUT", "LAYT": "LAYOUT", "NGR": "NAGAR", "EXTN": "EXTENSION", "EXT": "EXTENSION",
    "APT": "APARTMENT", "APTS": "APARTMENT", "APPT": "APARTMENT", "APPTS": "APARTMENT", "APRT": "APARTMENT", "APTMT": "APARTMENT", "APARTMENTS": "APARTMENT", "APPARTMENT": "APARTMENT", "APPARTMENTS": "APARTMENT",
    "BLDG": "BUILDING", "BLD": "BUILDING", "BLG": "BUILDING", "HSE": "HOUSE", "HS": "HOUSE", "FLR": "FLOOR", "FLRS": "FLOOR", "GRND": "GROUND", "OPP": "OPPOSITE", "NR": "NEAR", "BHND": "BEHIND", "PH": "PHASE", "BLK": "BLOCK",
    "SEC": "SECTOR", "STG": "STAGE", "SY": "SURVEY", "VLG": "VILLAGE", "PO": "POST", "HNO": "HOUSE NO", "DNO": "DOOR NO", "FLT": "FLAT", "SOC": "SOCIETY", "TWR": "TOWER", "RESI": "RESIDENCY", "RESD": "RESIDENCY",
    "COLNY": "COLONY", "GRDN": "GARDEN", "GRDNS": "GARDEN", "MRG": "MARG", "HWY": "HIGHWAY", "JN": "JUNCTION", "CIR": "CIRCLE",
}
MATCH_ABBREVIATIONS = {"RD": "ROAD", "NGR": "NAGAR", "LYT": "LAYOUT", "EXTN": "EXTENSION", "STG": "STAGE", "PH": "PHASE"}
GEO_TOKENS = ["BANGALORE", "BENGALURU", "KARNATAKA", "INDIA", "MUMBAI", "MAHARASHTRA", "PUNE", "HYDERABAD", "TELANGANA", "CHENNAI", "TAMILNADU", "DELHI", "GURGAON", "GURUGRAM", "NOIDA", "KOLKATA", "THANE", "URBAN", "RURAL", "NORTH", "SOUTH", "EAST", "WEST"]
CITY_ALIASES = {"bengaluru": "bangalore", "bangalore": "bangalore", "gurugram": "gurgaon", "gurgaon": "gurgaon", "mumbai": "mumbai", "bombay": "mumbai", "new delhi": "delhi", "delhi": "delhi", "ncr": "delhi", "navi mumbai": "navi mumbai", "greater noida": "noida", "noida": "noida", "pune": "pune"}
LANDMARK_WORDS = ["NEAR", "NR", "OPP", "OPPOSITE", "BEHIND", "BESIDE", "NEXT", "ADJACENT", "ABOVE"]
BRAND_STOP = [
    "THE", "AND", "NEW", "SRI", "SHRI", "URBAN", "INDIA", "CITY", "TOWN", "PARK", "GARDEN", "GARDENS", "HEIGHTS", "TOWER", "TOWERS", "HOUSE", "HOMES", "HOME", "VILLA", "VILLAS",
    "BLOCK", "PHASE", "SECTOR", "WEST", "EAST", "NORTH", "SOUTH", "MAIN", "CROSS", "ROAD", "NAGAR", "COLONY", "LAYOUT", "METRO", "CENTRAL", "ROYAL", "GREEN", "GOLD", "GRAND",
    "SUPREME", "PRIME", "LUXURY", "RESIDENCY", "APARTMENT", "APARTMENTS", "COMPLEX", "ENCLAVE", "WORLD", "ONE", "TWO", "THREE", "LAKE", "HILL", "HILLS", "VIEW", "LIFE", "LIVING",
    "SPACE", "CREST", "CREEK", "POINT", "PLAZA", "SQUARE", "COURT", "MANSION", "PALACE", "TEMPLE", "SCHOOL", "MASJID", "CHURCH", "BANGALORE", "BENGALURU", "MUMBAI", "KARNATAKA",
    "DELHI", "GURGAON", "GURUGRAM", "HYDERABAD", "PUNE", "CHENNAI", "NOIDA", "THANE", "WESTEND", "TOTAL", "ENVIRONMENT", "ASIAN", "SUN", "F", "B", "KA", "NO", "FLAT", "PLOT",
    "SHOP", "DOOR",
]
SUFFIX_WORDS = [
    "VILLA", "VILLAS", "APARTMENT", "APARTMENTS", "APTS", "TOWER", "TOWERS", "SOCIETY", "COMPLEX", "ENCLAVE", "HEIGHTS", "RESIDENCY", "RESIDENCES", "PLAZA", "COURT", "MANSION",
    "ARCADE", "SQUARE", "MEADOWS", "NIVAS", "HOMES", "PALACE", "CHAMBERS", "APPT", "APPTS", "NEST", "NESTS", "LAYOUT",
]
GENERIC_EXTRA = [
    "SREE", "SAI", "BDA", "FLATS", "BUILDING", "NILAYA", "NILAYAM", "NIVAS", "RESIDENCE", "APPARTMENT", "APPARTMENTS", "ENCLAVE", "MEADOWS", "PARADISE", "PRIDE", "AVENUE",
]
GENERIC_WORDS = sorted({*BRAND_STOP, *SUFFIX_WORDS, *GENERIC_EXTRA})
REJECT_WORDS = [
    "PVT", "LTD", "LIMITED", "PRIVATE", "LLP", "INC", "CORP", "CORPORATION", "TECHNOLOGIES", "TECHNOLOGY", "GLOBALSOFT", "SOLUTIONS", "SERVICES", "IND", "INDIA", "KA", "RE", "RU",
    "ORE", "BAN", "BANG", "BANGAL", "BANGALOR", "BANGALORE", "BENGALURU", "BENGALUR", "ANGALORE", "ALORE", "STRE", "ET", "HALI", "ST", "PH", "ASE", "EXTN", "TALUK",
]
BUILDING_STOP = [
    "BANGALORE", "BENGALURU", "KARNATAKA", "INDIA", "MAIN", "CROSS", "ROAD", "FLOOR", "NEAR", "BEHIND", "PHASE", "SECTOR", "BLOCK", "WEST", "EAST", "NORTH", "SOUTH", "FIRST",
    "SECOND", "THIRD", "FOURTH", "FIFTH", "GROUND", "BASEMENT", "PLOT", "DOOR", "SHOP", "FLAT", "NO", "UNIT",
]
LOCALITY_SUFFIXES = [
    "NAGAR", "LAYOUT", "COLONY", "GARDEN", "GARDENS", "PARK", "PURAM", "PURA", "HALLI",
]
BUILDING_SUFFIX = "APARTMENT|APARTMENTS|APTS|TOWER|TOWERS|SOCIETY|COMPLEX|ENCLAVE|HEIGHTS|RESIDENCY|RESIDENCES|VILLA|VILLAS|PLAZA|COURT|MANSION|ARCADE|SQUARE|ORCHIDS|SUNFLOWER|FORTUNA|ATLANTIS|MEADOWS|NIVAS|HOMES|PALACE|CHAMBERS|HERITAGE|REGENCY|CHALET|CHALETS|CASTLE|COUNTOUR|HABITAT|SEASONS|SPRINGS|NILAYA|NILAYAM|BHAVAN|BHAVANA|KUTEER|KUNJ|APPT|APPTS|NEST|NESTS"
GLUE_WORDS = "BENGALURU|BANGALORE|BENGALUR|BANGALOR|KARNATAKA|LAYOUT|CROSS|STAGE|PHASE|FLOOR"
RULE_RANK = {"project_locality_pincode": 4, "project_locality": 3, "project_pincode": 2, "project_unique_nearby": 1}
RULE_WEIGHT = {"project_locality_pincode": 0.20, "project_locality": 0.16, "project_pincode": 0.12, "project_unique_nearby": 0.10}
SOURCE_WEIGHT = {"dotcom_match": 0.10, "dotcom_subloc": 0.09, "pincode_map": 0.08, "gazetteer": 0.08, "pincode_fuzzy": 0.06, "ner": 0.05, "parser": 0.04}
ROMAN = {"I": "1", "II": "2", "III": "3", "IV": "4", "V": "5", "VI": "6"}
NEARBY_KM, CITY_RADIUS_KM, BRAND_MIN = 4.7, 40.0, 15
LEARNED_COUNT, LEARNED_SHARE = 3, 0.03
RELATIONS = ["S/O", "C/O", "D/O", "W/O", "SON OF", "DAUGHTER OF", "WIFE OF", "CARE OF"]
UNIT_STARTS = ["FLAT", "HOUSE", "PLOT", "DOOR", "SHOP", "APARTMENT", "BUILDING", "NO", "H NO"]
FIRM_ENDS = ["PVT", "PRIVATE", "LTD", "LIMITED", "LLP", "INC", "CORP", "CORPORATION", "TECHNOLOGIES", "TECHNOLOGY", "SOFTWARE", "SOLUTIONS", "SERVICES", "SYSTEMS", "CONSULTING", "NETWORK", "NETWORKS"]
FIRM_TAILS = ["PVT", "PRIVATE", "LTD", "LIMITED", "LLP", "INDIA"]
LANDMARK_PHRASES = ["NEAR", "NEXT TO", "OPPOSITE", "BEHIND", "BESIDE", "IN FRONT OF", "ADJACENT TO", "ABOVE", "BELOW"]
COMPOUND_ENDS = ["VILLA", "VILLAS", "NILAYA", "NIVAS", "HEIGHTS", "TOWERS", "APPT", "NEST", "NESTS"]
SOCIETY_ENDS = ["NAGAR", "COLONY", "GARDEN", "GARDENS", "PURAM", "PURA", "HALLI", "PET", "PALYA"]
SINGLE_AREA_ENDS = ["PURAM", "PURA", "HALLI", "LAYOUT", "COLONY", "GARDEN", "NAGAR", "ENCLAVE", "ESTATE", "TOWNSHIP"]
ENCLAVE_ENDS = ["ENCLAVE", "ESTATE", "TOWNSHIP"]
LOCALITY_ENDS = ["LAYOUT", "COLONY", "GARDEN", "NAGAR", "PURAM", "PURA", "HALLI", "EXTENSION", "ENCLAVE", "TOWNSHIP"]
AREA_PHRASE_ENDS = [
    "NAGAR", "COLONY", "LAYOUT", "VIHAR", "PURAM", "PURI", "PURA", "GANJ", "BAGH", "ENCLAVE", "EXTENSION", "TOWNSHIP", "CHOWK", "MOHALLA", "WADI", "HALLI", "PALLY", "PET", "KUNJ", "PARK", "GARDENS", "ESTATE", "SECTOR",
    "PHASE", "BLOCK", "CROSS", "MAIN ROAD", "MAIN",
]
AREA_SUFFIXES = ["NAGAR", "NAGARA", "LAYOUT", "COLONY", "GARDEN", "GARDENS", "PURA", "PURAM", "HALLI", "HALLY", "PALYA", "PALYAM", "PET", "PETE", "EXTENSION", "ENCLAVE", "TOWN", "VILLAGE", "SANDRA", "KERE", "GUDI", "WADI", "AGRAHARA"]
STREET_TOKENS = ["MAIN", "CROSS", "ROAD", "BLOCK", "FLOOR", "STAGE", "PHASE", "SECTOR", "FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "NORTH", "SOUTH", "EAST", "WEST"]
COMMON_LOCALITIES = [
    "JAYANAGAR", "VIJAYANAGAR", "BASAVANAGUDI", "BANASHANKARI", "KORAMANGALA", "INDIRANAGAR", "WHITEFIELD", "MARATHAHALLI", "HEBBAL", "YELAHANKA", "RAJAJINAGAR", "MALLESHWARAM", "MAHADEVAPURA", "DOMLUR", "ULSOOR",
    "ELECTRONIC CITY", "BELLANDUR", "SARJAPUR", "HORAMAVU", "KAGGADASAPURA", "BANASWADI", "PEENYA", "NAGARBHAVI", "SUBRAMANYAPURA", "UTTARAHALLI", "KENGERI", "DASARAHALLI", "BTM LAYOUT", "HSR LAYOUT",
]
LANDMARK_STOPS = ["INDIA", "KARNATAKA", "TAMIL NADU", "ANDHRA PRADESH"]
STATES = {
    "AN": "Andaman and Nicobar Islands", "AP": "Andhra Pradesh", "AR": "Arunachal Pradesh", "AS": "Assam", "BR": "Bihar", "CG": "Chhattisgarh", "CH": "Chandigarh", "CT": "Chhattisgarh", "DD": "Daman and Diu",
    "DL": "Delhi", "DN": "Dadra and Nagar Haveli and Daman and Diu", "GA": "Goa", "GJ": "Gujarat", "HP": "Himachal Pradesh", "HR": "Haryana", "JH": "Jharkhand", "JK": "Jammu and Kashmir", "KA": "Karnataka", "KL": "Kerala",
    "LA": "Ladakh", "LD": "Lakshadweep", "MH": "Maharashtra", "ML": "Meghalaya", "MN": "Manipur", "MP": "Madhya Pradesh", "MZ": "Mizoram", "NL": "Nagaland", "OD": "Odisha", "OR": "Odisha", "PB": "Punjab", "PY": "Puducherry",
    "RJ": "Rajasthan", "SK": "Sikkim", "TN": "Tamil Nadu", "TR": "Tripura", "TS": "Telangana", "UK": "Uttarakhand", "UL": "Uttarakhand", "UP": "Uttar Pradesh", "UT": "Uttarakhand", "WB": "West Bengal",
}
DEFAULT_STATE = "MH"
VOCABULARY = ["ROAD", "MAIN", "POST", "GATE", "HALL", "PARK", "LANE", "BANGALORE", "BENGALURU", "KARNATAKA", "INDIA", "APARTMENT", "LAYOUT", "NAGAR", "CROSS", "PHASE", "STAGE", "BLOCK", "FLOOR", "VILLAGE", "COLONY", "GARDEN", "TOWER", "RESIDENCY", "ENCLAVE", "HOUSE", "BUILDING", "SOCIETY", "EXTENSION"]
