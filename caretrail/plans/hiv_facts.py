"""What the HIV care datasets read from an encounter: questions and answer codes as data.

A site with another concept dictionary passes its own fact table; the jobs only know the names.
"""

from __future__ import annotations

from caretrail.operators.facts import Fact, asked, code, date, day, drugs, number, said

CONTRACEPTIVES = (5275, 6220, 780, 5279, 907, 6218, 6700, 6701, 5274, 9510, 9511, 9734, 9735, 6217)
TB_TESTS = (12, 307, 8064, 2311, 2323)
LINE_1, LINE_2, LINE_3 = (6467, 6964, 792, 633, 631, 9759), (794, 635, 6160, 6159), (6156,)
DRUG_QUESTIONS = (1250, 1088, 2154)

# Concepts and answer codes of the care forms.
FACTS: dict[str, Fact] = {
    # enrolment and scheduling
    "enrolled_on": date(7013),
    "transferred_in": asked(7015),
    "transferred_in_site": said(7015, 1287),
    "enrolled_elsewhere": said(7030, 5622),
    "scheduled_visit": code(1839),
    "rtc": date(5096),
    "med_pickup": date(9605),
    # visits that the summary leaves out: not known to be infected, found negative
    "status_not_positive": said(5303, 822, 664, 1067),
    "exit_negative": said(9082, 9036),
    # leaving care
    "discharged": said(1946, 1065),
    "transfer_code": code(1285),
    "transfer_away": said(1285, 1287, 9068),
    "transfer_other": said(1285, 1287, 9068, 2050),
    "transfer_network": said(1285, 1286),
    "exit_code": code(1596),
    "exit_transfer": said(1596, 1594),
    "care_code": code(9082),
    "care_left": said(9082, 159, 9036, 9083, 1287, 9068, 9079, 9504, 1285),
    "care_transfer": said(9082, 1287, 1594, 9068, 9504, 1285),
    "death_on": date(1570),
    "death_cause": asked(1734, 1573),
    "died": said((1733, 9082, 6206), 159),
    # diagnosis and treatment
    "hiv_on": date(9203),
    "arv_hard_start": said(1255, 1256, 1259, 1850),
    "arv_soft_start": said(1255, 1257, 1259, 981, 1258, 1849, 1850),
    "arv_started_now": said(1255, 1256),
    "arv_stop": said(1255, 1107, 1260),
    "drugs_now": drugs(1250),
    "drugs_started": asked(1250),
    "drugs_current": drugs(1088),
    "drugs_current_asked": asked(1088),
    "drugs_current_none": said(1088, 1107),
    "drugs_reported": drugs(2154),
    "drugs_reported_asked": asked(2154),
    "drugs_reported_none": said(2154, 1066),
    "drugs_past": drugs(2157),
    "drugs_past_asked": asked(2157),
    "drugs_past_none": said(2157, 1066),
    "first_arv_on": date(1499),
    "first_arv_known": asked(1633),
    "first_arv_regimen_known": said(1633, 1065),
    "line_1250_1": said(1250, *LINE_1),
    "line_1250_2": said(1250, *LINE_2),
    "line_1250_3": said(1250, *LINE_3),
    "line_1088_1": said(1088, *LINE_1),
    "line_1088_2": said(1088, *LINE_2),
    "line_1088_3": said(1088, *LINE_3),
    "line_2154_1": said(2154, *LINE_1),
    "line_2154_2": said(2154, *LINE_2),
    "line_2154_3": said(2154, *LINE_3),
    "line_reported_1": said((6976, 6744), 6693),
    "line_reported_2": said((6976, 6744), 6694),
    "line_reported_3": said((6976, 6744), 6695),
    "adherence_good": said(8288, 6343),
    "adherence_fair": said(8288, 6655),
    "adherence_poor": said(8288, 6656),
    "disclosed": said(6596, 6594, 1267, 6595),
    "not_disclosed": said(6596, 1118),
    # pregnancy
    "not_pregnant": said(8351, 48, 50, 1066, 1624, 6971, 9608),
    "pregnant": said(8351, 1065, 1484),
    "gestation_asked": asked(1279, 5596),
    "last_period": date(1836),
    "gestation_weeks": number(1279),
    "due_on": date(5596),
    "delivered": asked(5599),
    "delivered_now": said(1156, 1065),
    "pregnancy_over": said(1145, 1065),
    # tuberculosis
    "tb_test_asked": asked(6174, 307, 12, 2028),
    "tb_test_ordered": said((1271, 1866), *TB_TESTS),
    "tb_symptom": said((2022, 2020, 2021), 1065),
    "tb_cough": said(5958, 1077),
    "tb_exam": said((5959, 5971), 1073, 1074),
    "tb_none": said(1492, 107),
    "tb_treatment_started": said(1268, 1256, 1850),
    "tb_contact": asked(1270),
    "tb_plan_continue": said(1268, 1257),
    "tb_result": code(8292),
    "tb_stop": said(1268, 1107, 1260),
    "tb_plan": asked(1268),
    "tb_drugs": asked(1111),
    "tb_drugs_none": said(1111, 1267, 1107),
    "tb_started_on": date(1113),
    "tb_start_now": said(1268, 1256),
    "tb_continue": said(1268, 1257, 1259, 1849, 981),
    "tb_end_on": date(2041),
    "tb_end_now": said(1268, 1260),
    # preventive treatment
    "ipt_stop": said(1265, 1107, 1260),
    "ipt_plan": asked(1265),
    "ipt_drug": said(1110, 656),
    "ipt_hard_start": said(1265, 1256, 1850),
    "ipt_soft_start": said(1265, 1257, 981, 1406, 1849),
    "ipt_history": said(10591, 1065),
    "ipt_started_on": date(1190),
    "ipt_stop_reason": asked(1266),
    "ipt_completed": said(1266, 1267),
    "ipt_ended_on": date(8603),
    "pcp_stop": said(1261, 1107, 1260),
    "pcp_hard_start": said(1261, 1256, 1850),
    "pcp_soft_start": said(1261, 1257),
    "pcp_drug": said((1109, 1193), 916, 92),
    # laboratory
    "vl": number(856),
    "vl_on": day(856),
    "vl_ordered": said(1271, 856),
    "cd4": number(5497),
    "cd4_percent": number(730),
    "cd4_ordered": said(1271, 657),
    "pcr": number(1030),
    "pcr_on": day(1030),
    "pcr_ordered": said(1271, 1030),
    "rapid_test": number(1040),
    # prevention and staging
    "condoms": said(8302, 8305),
    "condoms_method": said(374, 190, 6717, 6718),
    "condoms_given": asked(6579),
    "contraceptive": said(7240, *CONTRACEPTIVES),
    "contraceptive_374": said(374, *CONTRACEPTIVES),
    "contraceptive_none": said(7240, 1107),
    "contraceptive_no": said(9738, 1066),
    "contraceptive_code": code(7240),
    "contraceptive_374_code": code(374),
    "who_1": said((5356, 8287, 1224, 8307), 1204, 1220),
    "who_2": said((5356, 8287, 1224, 8307), 1205, 1221),
    "who_3": said((5356, 8287, 1224, 8307), 1206, 1222),
    "who_4": said((5356, 8287, 1224, 8307), 1207, 1223),
    "discordant_code": code(6096),
    # outreach
    "phone_tried": said(9063, 1065),
    "phone_attempt": said(9063, 1065, 1560, 9064, 9065, 9066, 5622),
    "phone_used": said(1569, 1555),
    "phone_method": said(1558, 1555),
    "phone_reached": said(9600, 1065),
    "phone_failed": said(9600, 1066),
    "home_tried": said(10085, 1065),
    "home_method": said((1558, 1569), 7066, 6116, 1556, 1557, 1567),
    "home_reached": said(1559, 1065),
    "home_failed": said(1559, 1066),
    "attempts_a": number(1553),
    "attempts_b": number(9062),
    # current form: cross-border, orphans, cervical screening, tuberculosis tests, breastfeeding, vitals
    "away_3_yes": said(11237, 1065),
    "away_3_no": said(11237, 1066),
    "away_6_yes": said(11238, 1065),
    "away_6_no": said(11238, 1066),
    "away_12_yes": said(11239, 1065),
    "away_12_no": said(11239, 1066),
    "border_service": code(11243),
    "country": code(11252),
    "ovc_reason": code(11219),
    "ovc_exit_on": date(11220),
    "cervix_no": said(10400, 1066),
    "cervix_yes": said(10400, 1065),
    "cervix_na": said(10400, 1175),
    "cervix_undone": said(10400, 1118),
    "cervix_result": code(10401),
    "cervix_result_on": date(10546),
    "tb_modality_xpert": asked(8070),
    "tb_modality_smear": asked(307),
    "tb_modality_culture": asked(2311),
    "tb_modality_lam": asked(1506),
    "tb_modality_xray": asked(12),
    "breastfeeding_yes": said(5632, 1065),
    "breastfeeding_no": said(5632, 1066),
    "weight": number(5089),
    "height": number(5090),
}

# The same facts with one other dictionary of visit concepts.
OTHER_EMR_FACTS: dict[str, Fact] = {
    **FACTS,
    "scheduled_visit_on": date(1246),
    "mdt_session": code(10994),
}

# Sessions of the multidisciplinary team form, by the question answered.
MDT_SESSIONS: list[tuple[int, tuple[int, ...]]] = [
    (4, (10532,)),
    (3, (10527, 10528, 10529, 10530, 10531)),
    (2, (10523, 10524, 10525, 10526)),
    (1, (10518, 10519, 10520, 10521, 10522)),
]
for _n, _concepts in MDT_SESSIONS:
    FACTS[f"mdt_{_n}"] = asked(*_concepts)
    OTHER_EMR_FACTS[f"mdt_{_n}"] = asked(*_concepts)

# The questionnaire that stands in for the forms over the test tables: (concept, kind, code).
QUESTIONS: list[tuple[int, str, int]] = (
    [(5096, "date", 0)] * 8
    + [(856, "number", 60)] * 3
    + [(1255, "coded", c) for c in (1256, 1257, 1259, 1850, 1107, 1260, 981)]
    + [(1250, "coded", c) for c in (6964, 6467, 794, 9759, 628, 6160, 6156, 10268)]
    + [(1088, "coded", c) for c in (6964, 1400, 633, 1107, 792)]
    + [(2154, "coded", c) for c in (6467, 1066)]
    + [(2157, "coded", c) for c in (630, 631, 1066)]
    + [(7013, "date", 0), (7015, "coded", 1287), (7030, "coded", 5622), (1839, "coded", 7850), (9605, "date", 0)]
    + [(1946, "coded", 1065), (1285, "coded", 1287), (1285, "coded", 1286), (1596, "coded", 1594), (9082, "coded", 9036)]
    + [(9082, "coded", 159), (9082, "coded", 9068), (5303, "coded", 822), (5303, "coded", 664), (5303, "coded", 1067), (5303, "coded", 703), (1570, "date", 0), (1573, "coded", 58), (9203, "date", 0), (1499, "date", 0), (1633, "coded", 1065)]
    + [(6976, "coded", c) for c in (6693, 6694)] + [(6744, "coded", 6695)]
    + [(8288, "coded", c) for c in (6343, 6655, 6656)] + [(6596, "coded", c) for c in (6594, 1118)]
    + [(8351, "coded", c) for c in (1065, 1066, 1484)] + [(1836, "date", 0), (1279, "number", 1), (5596, "date", 0), (5599, "date", 0)]
    + [(6174, "coded", 107), (2022, "coded", 1065), (1271, "coded", 307), (1271, "coded", 856), (1271, "coded", 657), (1271, "coded", 1030)]
    + [(8292, "coded", 6971), (8292, "coded", 6137), (1268, "coded", 1256), (1268, "coded", 1260), (1268, "coded", 1257), (1111, "coded", 1131)]
    + [(1113, "date", 0), (2041, "date", 0), (1265, "coded", 1256), (1265, "coded", 1257), (1265, "coded", 1260), (1266, "coded", 1267)]
    + [(10591, "coded", 1065), (1190, "date", 0), (8603, "date", 0), (1261, "coded", 1256), (1261, "coded", 1257), (1261, "coded", 1260), (1109, "coded", 916)]
    + [(5497, "number", 20), (730, "number", 1), (1030, "number", 14), (1040, "number", 14)]
    + [(8302, "coded", 8305), (374, "coded", 5275), (374, "coded", 190), (7240, "coded", 780), (7240, "coded", 1107), (9738, "coded", 1066)]
    + [(5356, "coded", c) for c in (1204, 1221)] + [(1224, "coded", c) for c in (1206, 1223)] + [(6096, "coded", c) for c in (1065, 1066, 6827)]
    + [(9063, "coded", 1065), (9600, "coded", 1065), (9600, "coded", 1066), (1558, "coded", 7066), (1559, "coded", 1065), (1553, "number", 1)]
    + [(11237, "coded", 1065), (11237, "coded", 1066), (11238, "coded", 1065), (11239, "coded", 1066), (11243, "coded", 5483), (11252, "coded", 11197)]
    + [(11219, "coded", 1504), (11219, "coded", 6834), (11220, "date", 0), (10400, "coded", 1065), (10400, "coded", 1066), (10401, "coded", 1115)]
    + [(10546, "date", 0), (8070, "coded", 703), (1506, "coded", 703), (5632, "coded", 1065), (5632, "coded", 1066), (5089, "number", 2), (5090, "number", 4)]
    + [(9063, "coded", 1560), (1569, "coded", 1555), (1558, "coded", 1555), (1559, "coded", 1066), (1145, "coded", 1065)]
    + [(10518, "coded", 1), (10523, "coded", 1), (10527, "coded", 1), (10532, "coded", 1)]
)

OTHER_EMR_QUESTIONS = QUESTIONS + [(1246, "date", 0), (1246, "coded", 1065), (10994, "number", 1), (10994, "number", 2)]

# Results a laboratory event can bring.
LAB_VALUES = {"vl": 856, "cd4": 5497, "cd4_percent": 730, "pcr": 1030}

# An event with one of these is no part of the care summary.
EXCLUDING = ("status_not_positive", "exit_negative")

# The facts that guarded results and pregnancy depend on; their concepts are scanned on their own.
DAY_FACTS = (
    *EXCLUDING,
    "vl", "vl_on", "pcr", "pcr_on", "gestation_asked", "pregnant", "not_pregnant", "delivered", "delivered_now", "pregnancy_over",
    "last_period", "gestation_weeks", "due_on",
)
