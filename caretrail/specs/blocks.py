"""Question blocks that several oncology forms share."""


def changed(block: str, **answers: str) -> str:
    """A block in which some columns have the concept and answers of one form."""
    lines = {line.split()[0]: line for line in block.strip().splitlines()}
    unknown = set(answers) - set(lines)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return "\n".join(f"{name} {answers[name]}" if name in answers else line for name, line in lines.items())


# Physical examination, answers in the order of their numbers.
PERFORMANCE = """
ecog_performance 6584 1115 6585 6586 6587 6588
"""
EXAM = """
general_exam 1119 1115 5201 5245 215 589
heent 1122 1118 1115 5192 516 513 5170 5334 6672
chest 1123 1118 1115 5138 5115 5116 5181 5127
heart 1124 1118 1115 1117 550 5176 5162 5164
abdomen_exam 1125 1118 1115 5105 5008 5009 581 5103
urogenital 1126 1118 1115 1116 2186 864 6334 1447 5993 8998 1489 8417 8261
extremities 1127 1118 1115 590 7293 134
nodal_survey 1121 1118 1115 1116 8261
musculoskeletal 1128 1118 1115 1116
neurologic 1129 1118 1115 599 497 5108 6005
"""
TESTICULAR = """
testicular_exam 8420 1118 1115 1116
"""
BREAST_EXAM = """
breast_findings 6251 1115 9689 9690 9687 9688 5313 6493 6250
breast_finding_location 9696 5141 5139 9625
breast_finding_quadrant 8268 5107 1883 1882 5104 9695
"""
LESIONS = """
lesions_body_part 8265 6599 6598 1237 1236 1349 6601 1350 6600 6597
lesions_laterality 8264 5139 5141 2399 1175
mass_measurement_first_direction 8270 text
mass_measurement_second_direction 8271 text
"""

# Imaging studies and their concepts; each is normal or abnormal.
NORMAL, ABNORMAL = 1115, 1116
IMAGING_CONCEPTS = {
    "ct_head": 846, "ct_neck": 9839, "ct_chest": 7113, "ct_abdomen": 7114, "ct_spine": 9840, "mri_head": 9881,
    "mri_neck": 9882, "mri_chest": 9883, "mri_abdomen": 9884, "mri_spine": 9885, "mri_arms": 9951, "mri_pelvic": 9952,
    "mri_legs": 9953, "ultrasound_renal": 7115, "ultrasound_hepatic": 852, "obstetric_ultrasound": 6221,
    "abdominal_ultrasound": 845, "breast_ultrasound": 9596, "x_ray_shoulder": 394, "x_ray_pelvis": 392,
    "x_ray_abdomen": 101, "x_ray_skull": 386, "x_ray_leg": 380, "x_ray_hand": 382, "x_ray_foot": 384, "x_ray_chest": 12,
    "x_ray_arm": 377, "x_ray_spine": 390,
}
IMAGING = "\n".join(f"{name} {concept} {NORMAL} {ABNORMAL}" for name, concept in IMAGING_CONCEPTS.items())
ECHO = """
echo 1536 1115 1116 1532 1533 1538 5622
"""

# Tests that can be ordered, in the order of their numbers.
TESTS = """
test_ordered 1271 1019 790 953 6898 9009 1327 10205 8595 8596 10125 10123 846 9839 7113 7114 9840 1536 9881 9882 9883 9951 9884 9952 9885 9953 845 9596 7115 852 394 392 101 386 380 882 384 12 377 390
other_radiology 8190 text
other_laboratory 9538 text
"""

# Staging, treatment and drugs.
STAGING = """
diagnosis_date 9728 text
cancer_stage 6582 1067 6566 10206 1175
overall_cancer_stage 9868 9851 9852 9853 9854 9855 9856 9857 9858 9859 9860 9861 9862 9863 9864 9865 9866 9867
"""
TREATMENT = """
treatment_plan 8723 7465 8427 6575 9626 10038 10232 5622
other_treatment_plan 10039 text
hospitalization 6419 1065 1066
radiation_location 9916 1349 8193 9226 9227 9228 9229 9230 9231 5622
surgery_reason 8725 8428 8724 8727 10233
surgical_procedure 10230 text
hormonal_drug 9918 8513 8514 8519 8515 8518 7217 10140 5622
targeted_therapies 10234 8489 8498 8501 5622
targeted_therapies_frequency 1896 1891 1099 7682 9933 1098 7772
targeted_therapy_start_date 10235 text
targeted_therapy_stop_date 10236 text
chemotherapy_plan 9869 1256 1259 1260 1257 6576
chemo_start_date 1190 text
treatment_intent 2206 9218 8428 8724 9219
chemo_regimen 9946 text
chemo_cycle 6643 text
total_planned_chemo_cycle 6644 text
"""
DRUGS = """
dosage_in_milligrams 1899 text
drug_route 7463 7458 10078 10079 7597 7581 7609 7616 7447
other_drugs 1895 text
other_medication 1779 text
purpose 2206 9220 8428
"""
RETURN = """
rtc_date 5096 text
"""
