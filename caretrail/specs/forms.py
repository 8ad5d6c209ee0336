"""Specs of the clinical forms: encounter types and questions."""

from caretrail.operators.forms import Form, form
from caretrail.specs.blocks import (
    BREAST_EXAM,
    DRUGS,
    ECHO,
    EXAM,
    IMAGING,
    LESIONS,
    PERFORMANCE,
    RETURN,
    STAGING,
    TESTICULAR,
    TESTS,
    TREATMENT,
    changed,
)

# Column, concept, answers in the order of their numbers. A column of concept 0 has no question yet.
CERVICAL_SCREENING = form(
    "cervical_cancer_screening",
    (69, 70, 147),
    """
reasons_for_current_visit 1834 9651 1154 1246 5622
cur_visit_type 1839 1838 1837 1246 7850 9569
actual_scheduled_date 7029 text
gravida 5624 num
parity 1053 num
menstruation_status 2061 5989 6496
last_menstrual_period_date 1836 text
pregnancy_status 8351 yesno
estimated_delivery_date 5596 text
reason_not_pregnant 9733 9729 9730 9731 9732
hiv_status 6709 664 703 1067
viral_load 856 num
viral_load_date 0 date
prior_via_done 9589 yesno
prior_via_result 7381 664 703
prior_via_date 0 date
cur_via_result 9590 1115 7469 9593 7472 7293 7470 6497 5245 9591 9592
visual_impression_cervix 7484 1115 7507 7508 7424 7425 7216 6537 7421 5622
visual_impression_vagina 7490 1115 1447 9181 1116 9177 7492 7491 7435 5622
visual_impression_vulva 7490 1115 1447 9177 1116 7489 7488 7483 5622
via_procedure_done 7479 1107 6511 7466 7147 9724 6510 885 7478 7553 1907 441 2062 7648 9434 5275 6220 5622
other_via_procedure_done 1915 text
via_management_plan 7500 9725 9178 7497 7383 7499 7496 7498 7465 7466 1496 1107 6102 7478 6511 5276 10200 5622
other_via_management_plan 1915 text
via_assessment_notes 7222 text
via_rtc_date 5096 text
history_of_dysplasia 7379 yesno
previous_via_result 7381 664 703
previous_via_result_date 0 date
most_recent_pap_smear_result 7423 1115 7417 7418 7419 7420 7421 7422
most_recent_biopsy_result 7426 1115 7424 7425 7216 7421
prior_biopsy_result_date 0 date
most_recent_biopsy_result_other 7400 text
prior_biopsy_result_date_other 0 date
date_patient_informed_referred 9706 text
past_dysplasia_treatment 7467 7466 7147 7465 5622
treatment_specimen_pathology 7579 1115 149 9620 7424 7425 7216 7421 9618
satisfactory_colposcopy 7428 1065=1 1066=0 1118=2
colposcopy_findings 7383 1115 7469 7473 7470 7471 7472
cervical_lesion_size 7477 7474 9619 7476
other_dysplasia_procedure_done 1915 text
dysplasia_mgmt_plan 7500 9725 9178 7497 7383 7499 5622
other_dysplasia_mgmt_plan 1915 text
dysplasia_assesment_notes 7222 text
dysplasia_rtc_date 5096 text
leep_location 8268 8266 8267
pathology_cervical_exam_findings 7645 1115 7424 7425 7216 1447 149 8282 9620 8276 9617 9621 7421 7422 9618
pathology_vaginal_exam_findings 7647 1115 7492 7491 7435 6537 1447 8282 9620 8276 9617 9621 7421 7422 9618
pathology_vulval_exam_findings 7646 1115 7489 7488 7483 9618 1447 8282 9620 8276 9617 9621 7421 7422
endometrium_biopsy_exam_findings 10207 1115 8276 9617 9621 9618 7421 8282 9620 7422
endocervical_curettage_exam_findings 10204 1115 7424 7425 7216 149 8282 9620 8276 9617 9621 7421 7422 9618
biopsy_results_mgmt_plan 7500 9725=1 9178=2 7498=2 7496=3 7497=4 7499=5 6105=6 7147=7 7466=8 10200=9
cancer_staging 9868 9852 9856 9860 9864
""",
)

# Column, concept, answers in the order of their numbers.
BREAST_SCREENING = form(
    "breast_cancer_screening",
    (86, 145, 146, 160),
    """
encounter_purpose 1834 9651 1154 1246 5622
other_encounter_purpose 1915 text
menstruation_before_12 9560 yesno
menses_stopped_permanently 9561 1065=1 1066=0 9568=2
menses_stop_age 9562 num
hrt_use 9626 1065=1 1066=0 9568=2
hrt_start_age 9627 num
hrt_end_age 9723 num
hrt_use_years 9629 num
hrt_type_used 9630 9573 6217 6218
given_birth 9563 yesno
age_first_birth 5574 num
gravida 5624 num
parity 1053 num
cigarette_smoking 9333 text
cigarette_smoked_day 2069 num
tobacco_use 7973 1065=1 1066=0 1679=2
tobacco_use_duration_yrs 8144 num
alcohol_drinking 1684 1065=1 1066=0 1679=2
alcohol_type 1685 1682 1681 1680 1683 2059 5622
alcohol_use_period_yrs 8170 num
breast_complaints_3months 9553 5006 1068
breast_mass_location 6697 2399 5139 5141 6589 6590 6591 9625
nipple_discharge_location 9557 5139 5141 9625
nipple_retraction_location 9558 5139 5141 9625
breast_erythrema_location 9574 5139 5141 9625
breast_rash_location 9577 5139 5141 9625
other_changes_location 9576 5139 5141 9625
history_of_mammogram 9594 yesno
mammogram_results 9595 1115 1116 1118 1138 1267 1067
breast_ultrasound_history 9597 yesno
breast_ultrasound_result 9596 1115 1116 1067 1118
history_of_breast_biopsy 9598 yesno
breast_biopsy_results 8184 1115 1116 1118 1067 9691 10052
number_of_biopsies 9599 text
biopsy_type 6509 6510 6511 6512 6513 7190 8184 10075 10076
prev_exam_results 9694 1115=1 1116=0 1067=2
fam_brca_history_bf50 9631 1672=1 1107=0 978=2 972=3 1671=4 1393=5 1392=6 1395=7 1394=8
fam_brca_history_aft50 9632 978 1672 972 1671 1393 1392 1395 1394
fam_male_brca_history 9633 978 1672 972 1671 1393 1392 1395 1394
fam_ovarianca_history 9634 978 1672 972 1671 1393 1392 1395 1394
fam_relatedca_history 9635 978 1672 972 1671 1393 1392 1395 1394
fam_otherca_specify 7176 6529=1 9636=2 9637=3 6485=4 9638=5 9639=6 6522=5 216=6
cur_physical_findings 6251 1115=0 115=1 6250=2 6249=3 5622=4 582=5 6493=6 6499=7 1118=8 1481=9 6729=10 1116=11 8188=12 8189=13 1067=14 9689=15 9690=16 9687=17 9688=18 5313=19 9691=20
lymph_nodes_findings 1121 1115 161 9675 9676
cur_screening_findings 9748 1115=1 9691=3 1116=2
patient_education 6327 9651 2345 9692 5622
referrals_ordered 1272 1107=0 1496=1
procedure_done 1272 9596 9595 6510 7190 6511 9997
referred_date 9158 text
next_app_date 5096 text
cbe_imaging_concordance 9702 9703 9704 1175
mammogram_workup_date 9708 text
date_patient_notified_of_mammogram_results 9705 text
ultrasound_results 9596 1115 1116 1067 1118
date_patient_notified_of_ultrasound_results 10047 text
fna_results 10051 9691 10052
fna_tumor_size 10053 num
fna_degree_of_malignancy 10054 10055 10056
fna_workup_date 10057 text
date_patient_notified_of_fna_results 10059 text
biopsy_workup_date 10060 text
date_patient_notified_of_biopsy_results 10061 text
biopsy_description 7400 text
diagnosis_date 9728 text
date_patient_informed_and_referred_for_management 9706 text
screening_mode 10068 9595 10067 9596
diagnosis 6042 text
cancer_staging 9868 9852 9856 9860 9864
hiv_status 6709 664 703 1067
""",
)

# Column, concept, answers in the order of their numbers.
LUNG_SCREENING = form(
    "lung_cancer_screening",
    (177, 185),
    """
cur_visit_type 1839 7037 7875
referral_from 6749 6572 8161 2242 978 5487 1275 5622
chief_complains 5219 107 5960 6786 136 7225 456 832 5622
complain_duration 8777 1072 1073 1074 8787
number_of_days 1892 text
number_of_weeks 1893 text
number_of_months 1894 text
number_of_years 7953 text
ever_smoked_cigarettes 6473 1065 1066 1679
number_of_sticks 2069 text
cigarette_duration 2070 text
tobacco_use 7973 1065 1066 1679
tobacco_duration 8144 text
main_occupation 1972 1967 1966 1971 8710 10369 10368 5622
chemical_exposure 10310 1107 10308 10370 10309 5622
asbestos_exposure 10312 1065 1066
other_cancer_in_family 9635 1107 978 1692 972 1671 1393 1392 1395 1394 1673
hiv_status 6709 1067 664 703
previous_tb_treatment 10242 1065 1066
number_of_tb_treatment 9304 text
previous_test_ordered 2028 1107 8064 9543 12 5622
sputum_aafbs_results 307 703 664 1118
gene_expert_results 8070 703 664 1138
x_ray_results 12 1115 1116 1118
procedure_ordered 10127 1107 10075 10076 10126 5622
imaging_test_ordered 1271 12 7113 5622
imaging_results 12 1115 1116 5622
radiology_test 8190 text
follow_up_care_plan 9930 1107 9725 5622
ct_findings 7113 1115 10318 2418 1136 5622
imaging_results_description 10077 text
biopsy_procedure_done 10391 1065 1066
biopsy_workup_date 10060 text
biopsy_results 10231 10052 10212 5622
other_condition 1915 text
type_of_malignancy 9846 text
other_malignancy 10390 text
lung_cancer_type 7176 10129 10130 5622
non_small_cancer 10132 7421 7422 10131 10209
repository_disease 10319 1295 58 10211 10210 5622
diagnosis_date 9728 text
referral_ordered 1272 10299 8161 8724 5486 10200 6570 5622
""",
    RETURN,
)

# Column, concept, answers in the order of their numbers.
BREAST_TREATMENT = form(
    "breast_cancer_treatment",
    (142, 143),
    """
cur_visit_type 1839 7037 7875
""",
    PERFORMANCE,
    changed(EXAM, chest="1123 1115=2 5138=3 5115=4 5116=5 5181=6 5127=7", neurologic="1129 1118 1115 599 497 5108"),
    changed(BREAST_EXAM, breast_finding_location="9696 5141 5139"),
    changed(LESIONS, lesions_laterality="8264 5139 5141"),
    """
skin_lessions 1120 1107 1118 582
currently_on_chemo 6575 1065 1107
test_ordered 1271 1107 1019 790 953 6898 9009
other_radiology 8190 text
other_laboratory 9538 text
method_of_diagnosis 6504 7189 6507 6505 6506
diagnosis_based_on_biopsy_type 6509 6510 6511 7190 6512
biopsy_concordance 6605 1065 1066
breast_cancer_type 9841 6545 9842 5622
chemo_drug 9918 text
referral_ordered 1272 1107 8724 5486 5884 6570 5622
""",
    STAGING,
    TREATMENT,
    DRUGS,
    RETURN,
)

# Column, concept, answers in the order of their numbers.
GENERAL_ONCOLOGY = form(
    "general_oncology_treatment",
    (38, 39),
    """
cur_visit_type 1834 1068 7850 1246 2345 10037
""",
    PERFORMANCE,
    changed(
        EXAM,
        general_exam="1119 1115 5201 5245 215 589 8999 991",
        chest="1123 1118 1115 5138 5115 5116 5181 5127 5209",
        urogenital="1126 1118 1115 1116 2186 864 6334 1447 5993 8998 1489 8417 6261",
        extremities="1127 1118 1115 590 7293 134 582",
        nodal_survey="1121 1118 1115 1116 161",
    ),
    BREAST_EXAM,
    TESTICULAR,
    LESIONS,
    """
skin_exam_findings 1120 1107 1118 582 1115 1116
condition_causing_focal_weakness 10071 10072 10073 10074
patient_on_chemo 6575 1065 1107
""",
    ECHO,
    IMAGING,
    """
method_of_diagnosis 6504 6505 6506 6507 6508 6902 7189
diagnosis_on_biopsy 6509 7190 6510 6511 6512 6513 10075 10076
biopsy_consistent_clinic_susp 6605 1065 1066
diagnosis_results 7191 text
cancer_type 7176 6485 6514 6520 6528 6536 6551 6540 6544 216 9846 10129 7175 5622
other_cancer 1915 text
type_of_sarcoma 9843 507 6486 6487 6488 6489 6490
type_of_gu 6514 6515 6516 6517 6518 6519 5622 8521
type_of_gi_cancer 6520 6521 6522 6523 6524 6525 6526 6527 6568 5622
head_and_neck_cancer 6528 6529 6530 6531 6532 6533 6534 5622 7421
gynecologic_cancer 6536 6537 6538 6539 5622 8422
lymphoma_cancer 6551 6553 6552 8423 5622
skin_cancer 6540 6541 6542 6543 5622
breast_cancer 9841 6545 9842 5622
other_solid_cancer 9846 8424 8425 9845 5622
type_of_leukemia 9844 6547 6548 6549 6550 5622
non_cancer 9847 1226 6556 9870 2 6557 5622
cancer_diagnosis_status 9848 9849 9850
treatment_on_clinical_trial 9917 1065 1066
chemo_drug 9918 8478 7217 7203 7215 7223 7198 491 7199 7218 7205 7212 8513 7202 7209 7197 8506 7210 8499 8492 8522 8510 8511 9919 8518 8516 8481 7207 7204 7201 8519 8507 8479 7213 10139 10140 5622
referral_ordered 1272 1107 8724 5484 7054 6419 5490 5486 5483 5622
""",
    STAGING,
    TESTS,
    TREATMENT,
    DRUGS,
    RETURN,
)

# Column, concept, answers in the order of their numbers.
LUNG_TREATMENT = form(
    "lung_cancer_treatment",
    (170, 169),
    """
cur_visit_type 1839 7037 7875
referred_from 6749 8161 5487 1275 2242 6572 978 5622
facility_name 6748 text
referral_date 9158 text
referred_by 10135 1496 6280 5507 5622
marital_status 1054 1175 1057 5555 6290 1060 1056 1058 1059
main_occupation 1972 1967 6401 6408 6966 1969 1968 1966 8407 6284 8589 5619 5622
patient_level_education 1605 1107 6214 6215 1604
smoke_cigarettes 6473 1065 1066 1679
number_of_sticks 2069 num
cigga_smoke_duration 2070 num
duration_since_last_use 2068 num
tobacco_use 7973 1065 1066 1679
tobacco_use_duration 8144 num
drink_alcohol 1684 1065 1066 1679
chemical_exposure 10310 1107 10308 10370 10309 5622
asbestos_exposure 10312 1065 1066
any_family_mem_with_cancer 6802 1065 1067
family_member 9635 1107 978 1692 972 1671 1393 1392 1395 1394 1673
chief_complaints 5219 136 107 6786 5954 832 5960 10121 5622
complain_duration 8777 1072 1073 1074 8787
number_days 1892 num
number_weeks 1893 num
number_months 1894 num
number_years 7953 num
""",
    PERFORMANCE,
    changed(EXAM, neurologic="1129 1118 1115 599 497 5108"),
    TESTICULAR,
    """
previous_tb_treatment 5704 text
ever_diagnosed 6245 142 5 6237 903 6033 43 58
disease_diagnosis_year 9281 num
hiv_status 6709 1067 664 703
chest_xray_result 12 1115 1116
chest_ct_scan_results 7113 1115 1117
pet_scan_results 10123 1115 1118
abdominal_ultrasound_result 845 1115 1119
other_imaging_results 10124 text
test_ordered 1271 1107 1019 790 953 6898 9009
other_radiology 8190 text
other_laboratory 9538 text
procedure_ordered 10127 1107 10075 10076 10126 5622
procedure_performed 10442 1107 10075 10076 10126 5622
other_procedures 1915 text
procedure_date 10443 text
lung_cancer_type 7176 10129 10130 5622
small_cell_lung_ca_staging 10137 6563 6564
non_small_cell_ca_type 10132 7421=1 7422=2 10131=3 10209=3
diagnosis_date 9728 text
staging 9868 9852 9856 9860 9864 6563 6564
cancer_staging_date 10441 text
metastasis_region 10445 text
treatment_plan 8723 6575 8427 7465 5622
other_treatment_plan 10039 text
radiotherapy_sessions 10133 num
surgery_date 10134 text
chemotherapy_plan 9869 1256 1259 1260 1257
chemo_start_date 1190 text
treatment_intent 2206 9218 8428 8724 9219
chemo_regimen 9946 text
chemo_cycle 6643 num
total_planned_chemo_cycle 6644 num
chemo_drug 9918 7202 8506 7210 8492 8507
referral_ordered 1272 1107 8724 5486 5884 6570 5622
""",
    DRUGS,
    RETURN,
)

# Urine tests share their answers; laboratory columns are all text.
URINE = {"pus_cells_in_urine": 1984, "protein_in_urine": 2339, "glucose_in_urine": 2340, "nitrites_in_urine": 9307}
MYELOMA_LABS = {
    "red_blood_cells_count": 679, "hemoglobin": 21, "mean_corpuscular_volume": 851, "mean_corpuscular_hemoglobin": 1018,
    "mean_cell_hemoglobin_concentration": 1017, "red_cell_distribution_width": 1016, "platelets_count": 729,
    "serum_white_blood_cells_count": 678, "absolute_neutrophil_count": 1330, "serum_uric_acid_test": 6134,
    "serum_creatinine": 790, "serum_sodium": 1132, "serum_potassium": 1133, "serum_chloride": 1134, "serum_albumin": 848,
    "serum_alpha_one_globulin": 8732, "serum_alpha_two_globulin": 8733, "serum_beta_globulin": 8734,
    "serum_gamma_globulin": 8735, "serum_m_protein": 8731, "urine_alpha_one_globulin": 8737,
    "urine_alpha_two_globulin": 8738, "urine_beta_globulin": 8739, "urine_gamma_globulin": 8740, "urinary_albumin": 849,
    "urine_m_protein": 8736, "kappa_light_chains": 10195, "kappa_lambda_ratio": 10197, "reticulocytes_percentage": 1327,
    "serum_total_bilirubin": 655, "serum_direct_bilirubin": 1297, "gamma_glutamyl_transferase": 6123,
    "serum_glutamic_oxaloacetic_transaminase": 653, "serum_glutamic_pyruvic_transaminase": 654,
    "serum_total_protein": 717, "serum_alkaline_phosphatase": 785, "serum_lactate_dehydrogenase": 1014,
}

# Column, concept, answers in the order of their numbers.
MYELOMA = form(
    "multiple_myeloma_treatment",
    (89, 90, 141),
    """
encounter_purpose 1834 7850 10037 2345 1068 1246 5622
""",
    PERFORMANCE,
    """
bp_systolic 5085 text
bp_diastolic 5086 text
heart_rate 5087 text
respiratory_rate 5242 text
temperature 5088 text
weight_kg 5089 text
height_cm 5090 text
blood_oxygen_saturation 5092 text
body_mass_index 1342 text
body_surface_area 980 text
diagnostic_method 6504 8594 6902 10142
diagnosis 6042 text
diagnosis_date 9728 text
cancer_stage 6582 1067 10206 6566 1175
overall_cancer_stage 9868 9852 9856 9860 9851 9854 9855 9864 9865
echo_test 1536 1115 1116 1538 1532 1533 5622
""",
    IMAGING,
    """
imaging_results_description 10077 text
clinical_media_caption_text 9057 text
other_imaging_results 10124 text
lab_test_ordered_for_next_visit 6583 1107 790 1019 953 10205 8596 8595 5622 1327 9009
lab_results_notes 9538 text
leukocytes_in_urine 6337 664 703 2074 2075 2301 10900
ketones_in_urine 7276 664 703 2074 2075 1138 10900 2301
""",
    "\n".join(f"{n} {k} 664 703 2074 2075" for n, k in URINE.items()),
    "\n".join(f"{n} {k} text" for n, k in MYELOMA_LABS.items()),
    """
oncology_treatment_plan 8723 10586 6575 1107 5622
other_treatment_plan 10039 text
remission_plan 10584 1260 10581 10582 10583
mm_supportive_care_plan 10198 88 257 8598 8597 1195 8410 7458 8479 10140 7207 5622
mm_signs_symptoms 10170 10141 1885 3 8592 5978 5949 5622
chemotherapy_plan 9869 1256 1259 1260 1257 6576
chemo_start_date 1190 text
chemo_cycle 6643 num
reason_chemo_stop 9927 1267 7391 6629 6627 1879 5622
chemo_drugs 9918 text
drug_route 7463 7458 10078 10079 7597 7581 7609 7616 7447
other_drugs 1895 text
other_medication 1779 text
reason_for_medication_use 2206 9220 8428
assessment_notes 7222 text
education_given_today 6327 8728 8742 1905 10208 8730 8371 5622
referral_ordered 1272 1107 8724 6571 1286 6572 6573 1905 5622
next_app_date 5096 text
""",
)

# Column, concept; all as text.
ONCOLOGY_HISTORY = form(
    "oncology_patient_history",
    (69, 70, 86, 145, 146, 147, 160, 38, 39, 40, 41, 42, 45, 130, 141, 148, 149, 150, 151, 175, 142, 143, 169, 170, 177, 91, 92, 89, 90, 93, 94, 184),
    """
diagnosis 7179 text
diagnosis_method 6504 text
result_of_diagnosis 7191 num
diagnosis_date 9728 text
breast_exam_findings 6251 text
prior_via_test_result 7381 text
prior_via_test_result_date 7381 day
via_test_result 9590 text
hiv_status 6709 text
cancer_type_asked 7176 text
cancer_type_diagnosed 6042 6555=6555
breast_cancer_type 9841 text
gynecologic_cancer_type 6536 text
sarcoma_type 9843 text
leukemia_type 9844 text
lymphoma_type 6551 text
other_solid_type 9846 text
skin_cancer_type 6540 text
head_and_neck_type 6528 text
genitourinary_type 6514 text
gastrointestinal_type 6520 text
lung_cancer_type 10132 text
non_cancer_diagnosis 9847 text
cancer_stage 6582 text
overall_cancer_stage_group 9868 text
medication_history 9918 text
cur_onc_meds_dose 1899 text
cur_onc_meds_frequency 1896 text
oncology_treatment_plan 8723 text
chemotherapy 6575 text
current_chemo_cycle 6643 text
total_chemo_cycles_planned 6644 text
therapeutic_notes 7222 text
cancer_diagnosis_status 9848 text
reasons_for_surgery 8725 text
chemotherapy_intent 2206 text
chemotherapy_plan 9869 text
chemotherapy_regimen 9946 text
drug_route 7463 text
other_meds_added 10198 text
sickle_cell_drugs 9710 text
""",
)

# Column, concept, answers in the order of their numbers.
SICKLE_CELL = form(
    "sickle_cell_treatment",
    (93, 94),
    """
cur_visit_type 1839 7850 2345 1246 1837 1838
who_referred_you 6749 978 7037 6479
travel_time 5605 1049 1050 1051 6412 6413 6414
mode_of_transportation 6468 6413 6416 6580 6469 6470 6471
main_occupation 1972 1967 6401 6408 6966 1969 1968 1966 8407 6284 8589 5619 5622
monthly_income 7003 7002 6313 6314 6315 6316 6317
household_size 6801 text
patient_level_of_education 1605 1107 6214 6215 1604
next_of_kin_level_of_education 8749 1107 6214 6215 1604
current_marital_status 1054 1175 1057 5555 6290 1060 1056 1058 1059
number_of_children 1728 text
uses_family_planning 6683 1065 1066 1679
breastfeeding 2056 1065 1066
smokes_cigarettes 6473 1065 1066 1679
sticks_per_day 2069 text
years_of_cigarette_use 2070 text
years_since_last_cigarette 2068 text
uses_tobacco 7973 1065 1066 1679
drinks_alcohol 1684 1065 1066 1679
""",
    PERFORMANCE,
    EXAM,
    TESTICULAR,
    ECHO,
    IMAGING,
    """
diagnosis_established_by 6504 9009 9008
hemoglobin_f 9010 text
hemoglobin_a 9011 text
hemoglobin_s 9699 text
hemoglobin_a2c 9012 text
screening_diagnosis 9008 703 664
diagnosis 6042 text
vaccination_given 984 1107 6957 9700
prescribed_drug 8726 7211 257 784 97 5622
dosage_in_milligrams 1899 text
duration_in_weeks 1893 text
other_prescribed_drug 1915 text
referrals 1272 1107 6569 6571 6572 6573 1905 1286 5622
""",
    TESTS,
    RETURN,
)

# Column, concept, answers in the order of their numbers.
HEMOPHILIA = form(
    "hemophilia",
    (91, 92),
    """
cur_visit_type 1834 7850 10037 2345 1246 1068
""",
    PERFORMANCE,
    EXAM,
    TESTICULAR,
    """
anatomic_location 9947 8770 8768 8772 8769 8771 8773 8782 1345 1347 8783
laterality 8264 5141 5139 2399
physical_activity 8797 8798=1 8799=2 8800=3 8801=3
recommendations 1705 1107 8802 8812 8804 8805 8808 8813 8806 8809 8814 8803 8810 8815 8807 8811 8816
age_at_diagnosis 8778 text
age_at_first_bleed 8779 text
site_first_bleed 8780 8771 8768 8769 8773 7941 8757 5622
bleeding_disorder 6402 8789 8790 8791 5622
severity 8792 1743 1744 1745 1067 8989
baseline_factor 8794 text
diagnosis_method 6504 8795 6506
confirmed_hematology 8796 1065=1 1066=2 1624=2
education_provided 6327 8817 8820 8823 7055 8821 8824 8821 2373
blood_transfusion 8743 8774 8775
referral 1272 1905 8825 1580 1902
reasons_for_referral 2327 1578 1548 2329 2330 5484 6502 5622 5096
""",
    ECHO,
    IMAGING,
    TESTS,
    RETURN,
)

# Column, concept, answers in the order of their numbers.
ANTICOAGULATION = form(
    "anticoagulation_treatment",
    (189, 190, 191),
    """
cur_visit_type 1839 7850 7037
temperature 5088 text
weight 5089 text
height 5090 text
systolic_bp 5085 text
diastolic_bp 5086 text
pulse 5097 text
respiratory_rate 5242 text
rcc 8899 text
lcc 8898 text
inr 8167 text
chief_complaint 8916 1107 1068
hospitalized_since_last_visit 976 yesno
signs_of_bleeding 8917 1066=0 1065=1 173=2 840=3 6787=4 8919=5 8920=6 8926=7
blood_in_stool 6787 1066=0 1065=1 1067=2
blood_in_urine 840 1066=0 1065=1 1067=2
bruising 8920 1066=0 1065=1 1067=2
gum_bleeds 8919 1066=0 1065=1 1067=2
epistaxis 173 1066=0 1065=1 1067=2
secondary_hemorrhage 8926 1066=0 1065=1 1067=2
severity 8792 1743 1744 1745
time_bleeding_symptoms_last 10490 10491 10492 1072
frequency_of_bleeding_symptoms 8929 8927 1891 1099 8928 1098
blood_transfusion_required 8930 yesno
units_of_blood_transfused 8412 text
symptoms_of_clot_or_embolism 8931 1066=0 1065=1 107=2 136=3
presumed_clot_location 1239 8940=1 8942=1 1237=1 1236=1
blood_clot_onset 8944 2329 2330
frequency_of_clot_symptoms 8927 1891 1099 8929
cough_duration 5959 1072 1073 1074
chest_pain_duration 5971 1072 1073 1074
chest_pain_location 5976 540 5139 541 5973 5141
chest_pain_quality 909 379 5972 705 762
change_in_activity_level 8823 1066=0 6619=0 2413=0
change_in_health_status 8947 1066=0 1065=1 6593=2 7899=3 5622=4
scheduled_for_surgery 8948 yesno
problem_added 2072 text
patient_type 1724 1965 5485
pregnancy_status 8351 1065 1066 1624 6791
insurance 6266 1107 8890 6815 8891 5622
health_assistance 8294 yesno
referral_from 6749 5485 1965
anticoag_duration_necessary 8849 8847 2305 2306 8551 8848 8897 5622
conditions_requiring_anticoag 8851 1531 6647 8040 5622
afib_indications 8852 221 8076 175 903 1456 8856 8857 8859 8858 8860 8861 8862 8866
dvt_or_pe_indications 8854 6218 1180 44 6647 1514 884 8868 8869 8870
hvd_indications 8853 8924 8925 8863 8864 8865 8866 8867
other_indications 8855 8871 1541 7996 8590 8872 1538 1540 5622
travel_to_clinic_time 5605 1049 1050 1051 1052 6412 6413 6414 8245 8246 8884 8885 8886 1958
transportation_mode 6468 6395 7552 6580 6416 6396 6471 6470 6415
year_diagnosed 8887 text
first_diagnosis_location 8888 8923 6181 1965
has_other_medical_condition 2073 1066=0 1065=1 1624=2
review_of_medical_history 6245 3 903 5622
hiv_status_known 6878 yesno
last_hiv_test_result 1362 1138 664 703
last_hiv_test_date 2388 text
enrolled_in_hiv_care 6152 yesno
has_medication_allergies 7111 yesno
medication_allergic_to 2089 text
allergic_reaction 2085 7954 107 879 512 6001 5980 5209 5622
smokes_cigarettes 2065 1066=0 1065=1 1679=2
sticks_smoked_per_day 2069 text
years_of_cig_use 2070 text
period_since_stopping_smoking 6581 text
years_since_last_cig_use 2068 text
uses_tobacco 7973 1066=0 1065=1 1679=2
years_of_tobacco_use 8144 text
uses_alcohol 1684 1066=0 1065=1 1679=2
type_of_alcohol_used 1685 1680 1683 1682 1681 2059
used_herbal_medicine 8828 yesno
herbal_medication_used 8889 text
adherence_prior_to_visit 8892 1107 1160 1161 1162 1163
medication_added 1895 text
medication_frequency 1896 1891 1888 1889 7772 1890
medication_side_effects 8896 107 8895 5987 5980 16 1486 8607 3 512 5622
change_in_meds_since_last_visit 8952 yesno
drug_action_plan 7885 1260 8957 8958 8959 8960 8961 8962 8956 8955 8974 8972 8973 5622
plan_milligrams 1899 text
plan_day_of_the_week 8963 8963 8964 8965 8966 8968 8969 8970
adherence_last_seven_days 8976 1163 1162 1160 1161 1107
nonadherence 9006 yesno
missed_medication_reason 1668 1648 6295 8978 1664 5622
number_of_tablets_other_drug 1898 text
was_protocol_followed 8982 yesno
injectable_stop_date 9007 text
test_ordered 1271 8991 21 1010 7872 1019 790 953 6898 9009 1327 10205 8595 8596 10125 10123 846 9839 7113 7114 9840 1536 9881 9883 9951 9884 9952 9885 9953 845 9596 6221 7115 852 394 392 101 101 386 380 382 12 377 390
radiology_test_ordered 8190 text
other_lab_orders 9538 text
referrals_ordered 1272 1107 5485 5507 5622
referral_urgency_level 8990 8989 8987 8847 7316
other_text 1915 text
assessment_notes 7222 text
""",
    RETURN,
)

# Column, concept, answers in the order of their numbers.
PEER_NAVIGATION = form(
    "cdm_peer_navigation",
    (193, 192),
    """
referral_urgency 10494 8989 7316 7314
referred_in_or_out 10114 10497 10112
initial_or_follow_up 1839 7850 2345
referring_or_receiving_peer 10382 10628 10629
lifestyle_modification_plan 9147 1065 1066
current_medication_regimen 10241 1242 1243 2265 250 2267 2276 7303 8834 8836
understand_bp_meds_and_purpose 1654 1065 1066
understand_meds_frequency 10451 1065 1066
last_regimen_change 10495 1107=1 1930=2 981=1 1260=2
missed_bp_meds_7days 10452 1065 1066
reason_meds_missed 1668 9148 1648 1664 6295 6100 1546 1647 9126 10453 1548 5622
reason_for_referral 2327 6411 6583 10496 1664 6451 1486 7342 1578 5622 1548 2329 2330 5484 6510 7465 6511 6502 7190 8262
barriers_to_complete_referral 10459 1107 10458 10457 1578 10455 820 1576 1577 1666 10456 1915
barriers_prevent_referral 10460 1065 1066
patient_referral_status 9082 10461 10462 10463 9083 1593 9079 1915
referral_preparation_discussed 10467 10464 6468 10465 10466
is_referral_completed 10462 1065 1066
concerns_preventing_referral 10486 1065 1066
next_peer_outreach 9166 text
""",
)

FORMS: dict[str, Form] = {
    "M42": BREAST_SCREENING,
    "M43": BREAST_TREATMENT,
    "M44": CERVICAL_SCREENING,
    "M45": GENERAL_ONCOLOGY,
    "M46": LUNG_SCREENING,
    "M47": LUNG_TREATMENT,
    "M48": MYELOMA,
    "M49": ONCOLOGY_HISTORY,
    "M50": SICKLE_CELL,
    "M51": HEMOPHILIA,
    "M52": ANTICOAGULATION,
    "M53": PEER_NAVIGATION,
}
