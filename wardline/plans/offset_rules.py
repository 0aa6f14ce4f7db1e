"""Names, ranges and recodes of the minute-offset source. Every value here is fixed."""

# --- fixed values -------------------------------------------------------------------------
FRAMES = {"d1": (-60, 1440), "h1": (-60, 60)}

# chemistry: stem, lab names, low, high, low closed, high closed
LABS = [
    ("albumin", ("albumin",), 0.5, 6.5, True, True),
    ("bilirubin", ("total bilirubin",), 0.2, 70.175, True, True),
    ("bun", ("BUN",), 1, 280, True, True),
    ("calcium", ("calcium",), 0, 9999, False, True),
    ("creatinine", ("creatinine",), 0.1, 28.28, True, True),
    ("glucose", ("bedside glucose", "glucose"), 1.8018, 1621.6, True, True),
    ("hco3", ("bicarbonate",), 0, 9999, True, True),
    ("hematocrit", ("Hct",), 5, 75, True, True),
    ("hemaglobin", ("Hgb",), 0, 9999, False, True),
    ("inr", ("PT - INR",), 0, 9999, False, True),
    ("lactate", ("lactate",), 0, 9999, False, True),
    ("platelets", ("platelets x 1000",), 0, 9999, False, True),
    ("potassium", ("potassium",), 0.05, 12, True, True),
    ("sodium", ("sodium",), 90, 215, True, True),
    ("wbc", ("WBC x 1000",), 0, 300, True, True),
]
GASES = [
    ("pao2", ("paO2",), 15, 720, True, True),
    ("paco2", ("paCO2",), 5, 250, True, True),
    ("ph", ("pH",), 6.5, 8.5, True, True),
    ("fio2", ("FiO2",), 0.2, 1.0, True, True),
    ("fio2", ("FiO2",), 20, 100, True, True),
]
# monitored vitals: stem, column, low, high (closed)
PERIODIC = [
    ("heartrate", "heartrate", 0, 400),
    ("resprate", "respiration", 0, 300),
    ("spo2", "sao2", 0, 100),
    ("sysbp_invasive", "systemicsystolic", 1, 300),
    ("diasbp_invasive", "systemicdiastolic", 1, 200),
    ("mbp_invasive", "systemicmean", 1, 334),
]
APERIODIC = [
    ("sysbp_noninvasive", "noninvasivesystolic", 1, 300),
    ("diasbp_noninvasive", "noninvasivediastolic", 1, 200),
    ("mbp_noninvasive", "noninvasivemean", 1, 334),
]
# charted vitals: stem, (label, name) pairs, low, high, closed
CHARTED = [
    ("heartrate", [("Heart Rate", "Heart Rate")], 0, 400, True),
    ("resprate", [("Respiratory Rate", "Respiratory Rate")], 0, 300, True),
    ("spo2", [("O2 Saturation", "O2 Saturation")], 0, 100, True),
    ("temp", [("Temperature", "Temperature (C)")], 25, 46, True),
    ("sysbp_invasive", [("Invasive BP", "Invasive BP Systolic")], 1, 300, True),
    ("diasbp_invasive", [("Invasive BP", "Invasive BP Diastolic")], 1, 200, True),
    ("mbp_invasive", [("Invasive BP", "Invasive BP Mean")], 1, 334, True),
    ("sysbp_noninvasive", [("Non-Invasive BP", "Non-Invasive BP Systolic")], 1, 300, True),
    ("diasbp_noninvasive", [("Non-Invasive BP", "Non-Invasive BP Diastolic")], 1, 200, True),
    ("mbp_noninvasive", [("Non-Invasive BP", "Non-Invasive BP Mean")], 1, 334, True),
    ("gcs", [("Glasgow coma score", "GCS Total"), ("Score (Glasgow Coma Scale)", "Value")], 2, 16, False),
    ("map", [("MAP (mmHg)", "Value"), ("Arterial Line MAP (mmHg)", "Value")], 1, 334, True),
]
CHARTED_CATEGORIES = ("Vital Signs", "Scores", "Other Vital Signs and Infusions")

OLDEST_AGE = "> 89"
MIN_AGE = 16
MIN_STAY_MINUTES = 240
STEPDOWN = "stepdown/other"
SCORE_VERSION = "IVa"
OUTCOMES = ("Expired", "Alive")
FIRST_STAY_TYPES = ("1", "2", "3", "4", "5", "6")
GENDER = {"Female": "F", "Male": "M"}
DIED = {"Alive": 0, "Expired": 1}
UNIT_ADMIT_SOURCE = {
    "Accident & Emergency": ["Direct Admit", "Emergency Department"],
    "Operating Room / Recovery": ["Operating Room", "Recovery Room", "PACU"],
    "Floor": ["Acute Care/Floor", "Chest Pain Center", "Floor", "Step-Down Unit (SDU)", "Observation", "Other"],
    "Other ICU": ["ICU", "ICU to SDU", "Other ICU"],
    "Other Hospital": ["Other Hospital"],
}
COMORBIDITIES = {
    "aids": "aids", "diabetes_mellitus": "diabetes", "cirrhosis": "cirrhosis",
    "hepatic_failure": "hepaticfailure", "lymphoma": "lymphoma", "leukemia": "leukemia",
    "solid_tumor_with_metastasis": "metastaticcancer", "immunosuppression": "immunosuppression",
}
# score inputs: output -> column, -1 meaning missing
SCORE_INPUTS = {
    "albumin_apache": "albumin", "bilirubin_apache": "bilirubin", "creatinine_apache": "creatinine",
    "glucose_apache": "glucose", "hematocrit_apache": "hematocrit", "heart_rate_apache": "heartrate",
    "map_apache": "meanbp", "sodium_apache": "sodium", "paco2_apache": "pco2", "pao2_apache": "pao2",
    "ph_apache": "ph", "paco2_for_ph_apache": "pco2", "resprate_apache": "respiratoryrate",
    "temp_apache": "temperature", "bun_apache": "bun", "urineoutput_apache": "urine", "wbc_apache": "wbc",
    "gcs_eyes_apache": "eyes", "gcs_motor_apache": "motor", "gcs_verbal_apache": "verbal",
    "gcs_unable_apache": "meds", "arf_apache": "dialysis", "intubated_apache": "intubated",
}
COUNTRY = "USA"
# ------------------------------------------------------------------------------------------
