"""Fixed values that decide who is allocated what."""

# User types.
ADMIN = 1
FACILITATOR = 2
STAFF_TYPES = (1, 2)
LEARNER_TYPES = (3, 4)
ALL_TYPES = (1, 2, 3, 4)

# Platform flags a subject may carry, per allocation path.
PLATFORMS = {"non_ple": (0, 2), "ple": (1, 2), "staff": (0, 1, 2)}

# Fixed value: the category of lessons that count.
LESSON_CATEGORY = "d78bc322-568f-4110-8e24-02ea444d48b7"

# Lesson types left out of the filtered outputs.
EXCLUDED_LESSON_TYPES = ("pdf", "mp4", "pdf web")

# The wording of the allocation_basis column.
ALLOCATION_BASIS = {
    "non_ple": "centre_subject [→ batch_subject if batch] [→ subject_trade if trade]",
    "ple": "centre_subject [→ subject_ple_career_path if career_path] [→ batch_subject if batch]",
    "staff": "centre_subject (admin: all; facilitator: facilitator_access; master_trainer: mastertrainer_access)",
}

PATHS = ("non_ple", "ple", "staff")

# Short keys of the JSON arrays.
PHASE_KEYS = {"prog_name": "pr", "project_id": "pi", "proj_name": "pn", "p_phase_id": "phi", "phase": "ph"}
SUBJECT_KEYS = {
    "sub_id": "i", "avg_score_a": "s", "avg_rating_a": "r", "c_sub_w_less_asse_c": "c", "a_sub_w_less_asse_c": "a",
    "a_sub_w_assess_c": "aa", "a_sub_w_lesson_c": "al", "c_sub_w_assess_c": "ca", "c_sub_w_less_c": "cl",
    "year_category": "y",
}
