"""Code sets and terminology maps.

Fixed values: they have to equal published clinical code sets and are stated plainly.
"""

from __future__ import annotations

# Comorbidity conditions, weight and ICD-10 prefixes. Diabetes without complications is handled apart.
CHARLSON = {
    "myocardial_infarction": (1, "I21 I22 I25.2"),
    "heart_failure": (1, "I50"),
    "peripheral_vascular": (1, "I70 I71 I73.9 I77.1 I79"),
    "cerebrovascular": (1, "I60 I61 I62 I63 I64 G45 G46"),
    "dementia": (1, "F00 F01 F02 F03 G30"),
    "pulmonary": (1, "J40 J41 J42 J43 J44 J45 J46 J47"),
    "rheumatic": (1, "M05 M06 M32 M33 M34 M35"),
    "peptic_ulcer": (1, "K25 K26 K27 K28"),
    "mild_liver": (1, "B18 K70 K71 K73 K74"),
    "diabetes_uncomplicated": (1, "E10 E11 E12 E13 E14"),
    "diabetes_complicated": (2, "E10.2 E11.2 E12.2 E13.2 E14.2"),
    "hemiplegia": (2, "G81 G82 G83"),
    "renal": (2, "N18 N19 Z49 Z94.0 Z99.2"),
    "malignancy": (2, "C0 C1 C2 C3 C40 C41 C43 C45 C46 C47 C48 C49 C5 C6 C70 C71 C72 C73 C74 C75 C76 C81 C82 C83 C84 C85 C88 C90 C91 C92 C93 C94 C95 C96 C97"),
    "severe_liver": (3, "K72.1 K72.9 K76.5 K76.6 K76.7"),
    "metastatic": (6, "C77 C78 C79 C80"),
    "hiv": (6, "B20 B21 B22 B23 B24"),
}

# Chronic conditions by ICD-10 prefix.
CHRONIC = {
    "DIABETES": "E08 E10 E11 E13",
    "HYPERTENSION": "I10 I11 I12 I13",
    "CHF": "I50",
    "CKD": "N18",
    "COPD": "J43 J44",
    "DEPRESSION": "F32 F33",
}

# Laboratory names to LOINC.
LOINC = {
    "hba1c": "4548-4", "hgba1c": "4548-4", "hemoglobin a1c": "4548-4", "a1c": "4548-4", "glycated hemoglobin": "4548-4", "glycohemoglobin": "4548-4",
    "glucose": "2345-7", "blood glucose": "2345-7", "fasting glucose": "1558-6", "creatinine": "2160-0", "serum creatinine": "2160-0", "egfr": "62238-1",
    "ldl": "2089-1", "ldl cholesterol": "2089-1", "hdl": "2085-9", "total cholesterol": "2093-3", "triglycerides": "2571-8",
    "wbc": "6690-2", "white blood cell count": "6690-2", "hemoglobin": "718-7", "hgb": "718-7", "platelet count": "777-3",
    "systolic blood pressure": "8480-6", "diastolic blood pressure": "8462-4", "heart rate": "8867-4", "bmi": "39156-5", "body weight": "29463-7", "body height": "8302-2",
}

# Drug names to RxNorm.
RXNORM = {
    "metformin": "860975", "metformin 500mg": "860975", "metformin 1000mg": "861007", "lisinopril": "314076", "lisinopril 10mg": "314076",
    "atorvastatin": "617310", "atorvastatin 40mg": "617314", "amlodipine": "197361", "aspirin": "1191", "aspirin 81mg": "243670",
    "insulin glargine": "274783", "furosemide": "202991", "omeprazole": "7646", "levothyroxine": "10582",
}

# ICD-10 codes to SNOMED CT.
SNOMED = {
    "I21.9": "57054005", "I10": "38341003", "E11.9": "44054006", "E11.65": "44054006", "N18.3": "700379002",
    "N18.4": "700378005", "J44.1": "195951007", "I50.9": "84114007", "F32.9": "35489007", "Z87.891": "160303001",
}

# Names of ADT events.
ADT_LABELS = {
    "A01": "Admission", "A02": "Transfer", "A03": "Discharge", "A04": "Registration", "A08": "Update",
    "A11": "Cancel Admission", "A13": "Cancel Discharge", "A28": "Add Person Information", "A31": "Update Person Information",
}
ADT_COARSE = {"A01": "admit", "A02": "transfer", "A03": "discharge"}

# Resource types that are taken in, patient classes, sexes, encounter classes.
RESOURCE_TYPES = ("Patient", "Encounter", "Observation", "Condition", "MedicationRequest", "MedicationAdministration", "Procedure", "AllergyIntolerance", "Immunization", "DiagnosticReport", "DocumentReference")
PATIENT_CLASS = {"I": "IMP", "O": "AMB", "E": "EMER", "R": "AMB"}
SEXES = ("M", "F", "O", "U", "A", "N", "C")
ED_CLASSES, INPATIENT_CLASSES = ("EMER", "E", "EM"), ("IMP", "I", "ACUTE")
HBA1C = "4548-4"
MEASURE = ("CDC_HBA1C_CONTROL_LESS_8", "NCQA")
