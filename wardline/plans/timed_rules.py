"""Item sets, ranges and terms of the absolute-time source. Every value here is fixed."""

# --- fixed values -------------------------------------------------------------------------
# vitals: label, items, low, high, low closed, high closed
VITALS = [
    ("heartrate", (211, 220045), 0, 300, False, False),
    ("resprate", (615, 618, 220210, 224690), 0, 70, False, False),
    ("tempf", (223761, 678), 70, 120, False, False),
    ("tempc", (223762, 676), 10, 50, False, False),
    ("spo2", (646, 220277), 0, 100, False, True),
    ("glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, None, False, False),
    ("sysbp_invasive", (51, 6701, 220050), 0, 400, False, False),
    ("diasbp_invasive", (8368, 8555, 220051), 0, 300, False, False),
    ("sysbp_noninvasive", (442, 455, 220179), 0, 400, False, False),
    ("diasbp_noninvasive", (8440, 8441, 220180), 0, 300, False, False),
    ("mbp_invasive", (52, 6702, 220052, 225312), 0, 400, False, False),
    ("mbp_noninvasive", (456, 443, 220181), 0, 400, False, False),
    ("pasys_invasive", (492, 220059), 0, 80, False, False),
    ("padias_invasive", (8448, 220060), 0, 80, False, False),
    ("pamean_invasive", (491, 220061), 0, 80, False, False),
]
# output stem: labels pooled into it
VITAL_COLUMNS = {
    "heartrate": ["heartrate"],
    "sysbp": ["sysbp_invasive", "sysbp_noninvasive"],
    "diasbp": ["diasbp_invasive", "diasbp_noninvasive"],
    "mbp": ["mbp_invasive", "mbp_noninvasive"],
    "resprate": ["resprate"],
    "temp": ["tempc", "tempf"],
    "spo2": ["spo2"],
    "glucose": ["glucose"],
    "sysbp_invasive": ["sysbp_invasive"],
    "diasbp_invasive": ["diasbp_invasive"],
    "sysbp_noninvasive": ["sysbp_noninvasive"],
    "diasbp_noninvasive": ["diasbp_noninvasive"],
    "mbp_invasive": ["mbp_invasive"],
    "mbp_noninvasive": ["mbp_noninvasive"],
    "pasys_invasive": ["pasys_invasive"],
    "padias_invasive": ["padias_invasive"],
    "pamean_invasive": ["pamean_invasive"],
}
HEART_RATE_ITEMS = (211, 220045)

# chemistry: label, items, low, high (closed ends; values must be positive)
LABS = [
    ("aniongap", (50868,), None, 10000),
    ("albumin", (50862,), 0.5, 6.5),
    ("bands", (51144,), None, 100),
    ("hco3", (50882,), 2, 60),
    ("bilirubin", (50885,), 0.2, 70.175),
    ("creatinine", (50912,), 0.1, 28.28),
    ("chloride", (50902,), None, 10000),
    ("calcium", (50893,), None, 200),
    ("glucose", (50931,), 1.8018, 1621),
    ("hematocrit", (51221,), 5, 100),
    ("hemoglobin", (51222,), None, 50),
    ("lactate", (50813,), None, 50),
    ("platelet", (51265,), None, 10000),
    ("potassium", (50971,), 0.05, 12),
    ("ptt", (51275,), None, 150),
    ("inr", (51237,), None, 50),
    ("pt", (51274,), None, 150),
    ("sodium", (50983,), 90, 215),
    ("bun", (51006,), 1, 280),
    ("wbc", (51300, 51301), None, 300),
]

# blood gas: label, item, low, high (closed ends; values must be positive)
GAS_SPECIMEN_ITEM = 50800
GASES = [
    ("aado2", 50801, None, None),
    ("baseexcess", 50802, None, None),
    ("bicarbonate", 50803, 2, 60),
    ("totalco2", 50804, 2, 60),
    ("carboxyhemoglobin", 50805, None, None),
    ("chloride", 50806, None, None),
    ("calcium", 50808, None, None),
    ("glucose", 50809, 1.8, 1621),
    ("hematocrit", 50810, 5, 75),
    ("hemoglobin", 50811, None, None),
    ("intubated", 50812, None, None),
    ("lactate", 50813, None, None),
    ("methemoglobin", 50814, None, None),
    ("o2flow", 50815, None, None),
    ("fio2", 50816, None, 100),
    ("so2", 50817, None, 100),
    ("pco2", 50818, 5, 250),
    ("peep", 50819, None, None),
    ("ph", 50820, 6.5, 8.5),
    ("po2", 50821, 15, 720),
    ("potassium", 50822, 0.05, 12),
    ("requiredo2", 50823, None, None),
    ("sodium", 50824, 100, 215),
    ("temperature", 50825, 25, 46),
    ("tidalvolume", 50826, None, None),
    ("ventilationrate", 50827, None, None),
    ("ventilator", 50828, None, None),
]
GAS_OTHER_ITEMS = (50807, 51545)
SPO2_ITEMS = (646, 220277)
FIO2_MIXED_ITEMS = (223835, 727)
FIO2_PERCENT_ITEMS = (3420, 3422)
FIO2_FRACTION_ITEMS = (190,)
SPO2_REACH_SECONDS = 2 * 3600
FIO2_REACH_SECONDS = 4 * 3600

# specimen model: intercept and po2 weight, then beta, column, contribution when missing
SPECIMEN_INTERCEPT = -0.02544
SPECIMEN_PO2 = 0.04598
SPECIMEN_TERMS = [
    (-0.15356, "spo2", -0.15356 * 97.49420 + 0.13429),
    (0.62100, "fio2_chart", 0.00621 * 51.49550 + -0.24958),
    (0.10559, "hemoglobin", 0.10559 * 10.32307 + 0.05954),
    (0.13251, "so2", 0.13251 * 93.66539 + -0.23172),
    (-0.01511, "pco2", -0.01511 * 42.08866 + -0.01630),
    (1.48000, "fio2", 0.01480 * 63.97836 + -0.31142),
    (-0.00200, "aado2", -0.00200 * 442.21186 + -0.01328),
    (-0.03220, "bicarbonate", -0.03220 * 22.96894 + -0.06535),
    (0.05384, "totalco2", 0.05384 * 24.72632 + -0.01405),
    (0.08202, "lactate", 0.08202 * 3.06436 + 0.06038),
    (0.10956, "ph", 0.10956 * 7.36233 + -0.00617),
    (0.00848, "o2flow", 0.00848 * 7.59362 + -0.35803),
]
ARTERIAL = "ART"
ARTERIAL_CUTOFF = 0.75
# gas summary: output stem -> column
GAS_SUMMARY = {
    "pao2": "po2", "paco2": "pco2", "pao2fio2": "pao2fio2", "aado2": "aado2_any", "ph": "ph",
    "baseexcess": "baseexcess", "bicarbonate": "bicarbonate", "totalco2": "totalco2",
    "hematocrit": "hematocrit", "hemoglobin": "hemoglobin",
    "carboxyhemoglobin": "carboxyhemoglobin", "methemoglobin": "methemoglobin",
    "chloride": "chloride", "calcium": "calcium", "temperature": "temperature",
    "potassium": "potassium", "sodium": "sodium", "lactate": "lactate", "glucose": "glucose",
}

# urine output
IRRIGANT_ITEM = 227488
URINE_ITEMS = (
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096,
    40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558,
    227488, 227489,
)

# coma scale
GCS_ITEMS = {"motor": (454, 223901), "verbal": (723, 223900), "eyes": (184, 220739)}
GCS_TUBE_TEXT = {723: "1.0 ET/Trach", 223900: "No Response-ETT"}
GCS_NORMAL = {"motor": 6, "verbal": 5, "eyes": 4}
GCS_REACH_SECONDS = 6 * 3600

# demographics: label, items, low, high (closed)
DEMOGRAPHIC_ITEMS = [
    ("weight", (762, 763, 226512, 224639), 20, 400),
    ("height", (920, 1394, 226707), 10, 100),
    ("pregnant", (225082,), 0, None),
    ("smoking", (227687, 225108), 0, None),
]
TOBACCO_USE_ITEM = 225108
SMOKING_LABELS = {0: "Never Smoked", 1: "Ex-Smoker", 2: "Current Smoker"}
# note patterns in order of trust, and the code each stands for
SMOKING_NOTES = [
    (r"(never|not|not a|none|non|no|no history of|no h\/o of|denies|denies any|negative)[\s-]?(smoke|smoking|tabacco|tobacco|cigar|cigs)", 0),
    (r"(smoke|smoking|tabacco|tobacco|tabacco abuse|tobacco abuse|cigs|cigarettes):[\s]?(no|never|denies|negative)", 0),
    (r"smoked no \[x\]|no etoh, tobacco|not drink alcohol or smoke|not drink or smoke|absence of current tobacco use|absence of tobacco use", 0),
    (r"(ex-smoker|ex-smok)", 1),
    (r"(smoke|smoking|tabacco|tobacco|cigar|cigs|marijuana|nicotine)", 2),
]

# cohort
MIN_AGE = 16
MIN_STAY_HOURS = 4
CODE_STATUS_ITEMS = (128, 223758)
LIMITED_CARE_TEXT = (
    "Comfort Measures", "Comfort measures only", "Do Not Intubate", "DNI (do not intubate)",
    "DNR / DNI", "Do Not Resuscita", "DNR (do not resuscitate)",
)
CHRONIC_DIALYSIS_CODES = ("5854", "5855", "5856")

# acute physiology score: variable -> (edges, points)
BANDS = {
    "heartrate": ([40, 50, 100, 110, 120, 140, 155], [8, 5, 0, 1, 5, 7, 13, 17]),
    "mbp": ([40, 60, 70, 80, 100, 120, 130, 140], [23, 15, 7, 6, 0, 4, 7, 9, 10]),
    "temp": ([33, 33.5, 34, 35, 36, 40], [20, 16, 13, 8, 2, 0, 4]),
    "resprate": ([6, 12, 14, 25, 35, 40, 50], [17, 8, 7, 0, 6, 9, 11, 18]),
    "hematocrit": ([41, 50], [3, 0, 3]),
    "wbc": ([1, 3, 20, 25], [19, 5, 0, 1, 5]),
    "creatinine": ([0.5, 1.5, 1.95], [3, 0, 4, 7]),
    "bun": ([17, 20, 40, 80], [0, 2, 7, 11, 12]),
    "sodium": ([120, 135, 155], [3, 2, 0, 4]),
    "albumin": ([2, 2.5, 4.5], [11, 6, 0, 4]),
    "bilirubin": ([2, 3, 5, 8], [0, 5, 6, 8, 16]),
    "glucose": ([40, 60, 200, 350], [8, 9, 0, 3, 5]),
}
ALWAYS_HIGH = ("bun", "bilirubin")
RENAL_FAILURE_CREATININE = ([1.5], [0, 10])
VENTILATED_RESPRATE_BELOW = 14
URINE_BANDS = ([400, 600, 900, 1500, 2000, 4000], [15, 8, 7, 5, 4, 0, 1])
AADO2_BANDS = ([100, 250, 350, 500], [0, 7, 9, 11, 14])
PAO2_BANDS = ([50, 70, 80], [15, 5, 2, 0])
HIGH_FIO2 = 0.5
# pH below edge -> (pCO2 edges, points)
ACID_BASE = [
    (7.20, [50], [12, 4]),
    (7.30, [30, 40, 50], [9, 6, 3, 2]),
    (7.35, [30, 45], [9, 0, 1]),
    (7.45, [30, 45], [5, 0, 1]),
    (7.50, [30, 35, 45], [5, 0, 2, 12]),
    (7.60, [40], [3, 12]),
    (None, [25, 40], [0, 3, 12]),
]
# coma points by eye opening closed / open: verbal, motor, points
COMA_EYES_CLOSED = [
    ((1,), (1, 2), 48), ((1,), (3, 4), 33), ((1,), (5, 6), 16),
    ((2, 3), (1, 2), 29), ((2, 3), (3, 4), 24),
]
COMA_EYES_OPEN = [
    ((1,), (1, 2), 29), ((1,), (3, 4), 24), ((1,), (5, 6), 15),
    ((2, 3), (1, 2), 29), ((2, 3), (3, 4), 24), ((2, 3), (5,), 13), ((2, 3), (6,), 10),
    ((4,), (1, 2, 3, 4), 13), ((4,), (5,), 8), ((4,), (6,), 3),
    ((5,), (1, 2, 3, 4, 5), 3), ((5,), (6,), 0),
]
RENAL_FAILURE_CR, RENAL_FAILURE_URINE = 1.5, 410
MORTALITY_INTERCEPT, MORTALITY_SLOPE = -4.4360, 0.04726

# recodes of the extract
ETHNICITY = {
    "Caucasian": ["WHITE", "WHITE - RUSSIAN", "WHITE - OTHER EUROPEAN", "WHITE - BRAZILIAN",
                  "WHITE - EASTERN EUROPEAN"],
    "African American": ["BLACK/AFRICAN AMERICAN", "BLACK/CAPE VERDEAN", "BLACK/HAITIAN",
                         "BLACK/AFRICAN", "CARIBBEAN ISLAND"],
    "Hispanic": ["HISPANIC OR LATINO", "HISPANIC/LATINO - PUERTO RICAN",
                 "HISPANIC/LATINO - DOMINICAN", "PORTUGUESE", "HISPANIC/LATINO - GUATEMALAN",
                 "HISPANIC/LATINO - CUBAN", "HISPANIC/LATINO - SALVADORAN",
                 "HISPANIC/LATINO - CENTRAL AMERICAN (OTHER)", "HISPANIC/LATINO - MEXICAN",
                 "HISPANIC/LATINO - COLOMBIAN", "SOUTH AMERICAN", "HISPANIC/LATINO - HONDURAN"],
    "Asian": ["ASIAN", "ASIAN - CHINESE", "ASIAN - ASIAN INDIAN", "ASIAN - VIETNAMESE",
              "ASIAN - FILIPINO", "ASIAN - CAMBODIAN", "ASIAN - OTHER", "ASIAN - KOREAN",
              "ASIAN - JAPANESE", "ASIAN - THAI"],
    "Native American": ["AMERICAN INDIAN/ALASKA NATIVE FEDERALLY RECOGNIZED TRIBE",
                        "AMERICAN INDIAN/ALASKA NATIVE"],
}
OTHER_ETHNICITY = "Other/Unknown"
ADMIT_SOURCE = {
    "Emergency Department": ["EMERGENCY ROOM ADMIT"],
    "Other Hospital": ["TRANSFER FROM HOSP/EXTRAM", "TRANSFER FROM OTHER HEALT"],
    "Direct Admit": ["CLINIC REFERRAL/PREMATURE", "TRANSFER FROM SKILLED NUR", "HMO REFERRAL/SICK",
                     "PHYS REFERRAL/NORMAL DELI"],
    "Other": ["** INFO NOT AVAILABLE **"],
    "Acute Care/Floor": ["TRSF WITHIN THIS FACILITY"],
}
DISCHARGE_LOCATION = {
    "Rehabilitation": ["REHAB/DISTINCT PART HOSP"],
    "Home": ["HOME WITH HOME IV PROVIDR", "HOME HEALTH CARE", "HOME"],
    "Skilled Nursing Facility": ["SNF", "SNF-MEDICAID ONLY CERTIF"],
    "Nursing Home": ["HOSPICE-MEDICAL FACILITY", "HOSPICE-HOME"],
    "Other Hospital": ["SHORT TERM HOSPITAL", "LONG TERM CARE HOSPITAL", "DISC-TRAN TO FEDERAL HC",
                       "DISCH-TRAN TO PSYCH HOSP", "DISC-TRAN CANCER/CHLDRN H"],
    "Other": ["LEFT AGAINST MEDICAL ADVI"],
    "Other External": ["OTHER FACILITY", "ICF"],
    "Death": ["DEAD/EXPIRED"],
}
HOSPITAL = {"country": "USA", "hospital_id": "-1", "teaching_hospital": "1",
            "hospital_bed_size": ">= 500", "hospital_bed_size_numeric": 651}
# ------------------------------------------------------------------------------------------
