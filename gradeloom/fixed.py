"""Fixed values.

Every text below is part of the output format or of a matching rule, so it has
to be exactly this for results to agree.
"""

# Chat system prompt used when training conversations are built.
TRAINING_SYSTEM_PROMPT = (
    "你是一名耐心、严谨、擅长分步讲解的数学老师。"
    "请按“题意理解、思路、步骤、答案、总结”结构作答，并确保最终答案明确。"
)

# Chat system prompt used when the tutor answers a question.
TUTOR_SYSTEM_PROMPT = (
    "你是一名耐心、严谨、擅长分步讲解的数学老师。"
    "请按“题意理解、思路、步骤、答案、总结”结构回答问题，并确保最终答案明确。"
)

# Lead-ins of the two prompt styles; the question text follows directly.
RL_PROMPT_LEAD = (
    "请像数学辅导老师一样解答下面的问题。\n"
    "要求按“思路、步骤、答案”给出结构化输出，并确保最终答案明确。\n\n"
    "题目："
)
USER_PROMPT_LEAD = "请讲解并解答下面的数学题：\n"

# Tutor-style response: headings, standing texts and fallbacks.
TUTOR_OVERVIEW = "题意理解：\n这道题需要根据已知条件进行数学推导，并给出清晰的结论。\n\n"
TUTOR_THOUGHT_HEADING = "思路：\n"
TUTOR_STEPS_HEADING = "步骤：\n"
TUTOR_ANSWER_HEADING = "答案：\n"
TUTOR_SUMMARY = "总结：\n先根据条件建立关系，再逐步化简并检查最终结果。"
DEFAULT_THOUGHT = "先分析题目条件，再逐步求解。"
DEFAULT_STEPS = "请根据题目条件逐步推导。"
PENDING_ANSWER = "待求"

# Sections a well-formed answer must contain.
REQUIRED_SECTIONS = ("思路", "步骤", "答案")

# Default weights of the combined reward.
CORRECTNESS_WEIGHT = 0.5
MODEL_WEIGHT = 0.3
FORMAT_WEIGHT = 0.2

# Text handed to a scoring model.
SCORER_PROMPT_LABEL = "问题："
SCORER_RESPONSE_LABEL = "\n\n回答："

# Prompts used for calibration when no prepared table exists.
FALLBACK_CALIBRATION_PROMPTS = (
    "题目：若 2x + 3 = 11，求 x。",
    "题目：已知三角形三边分别为 3、4、5，求面积。",
)

# Candidate column names, tried in this order.
SFT_PROMPT_FIELDS = ("prompt", "problem", "question", "instruction", "query", "input")
SFT_SOLUTION_FIELDS = ("response", "solution", "output", "completion", "reasoning", "cot")
SFT_ANSWER_FIELDS = ("answer", "final_answer", "target", "label", "final")
RL_QUESTION_FIELDS = ("question", "problem", "prompt", "instruction", "query")
RL_ANSWER_FIELDS = ("answer", "target", "final_answer")
REWARD_PROMPT_FIELDS = ("prompt", "instruction", "question", "query")
REWARD_ANSWER_FIELDS = ("answer", "target", "final_answer")
REWARD_RESPONSE_FIELDS = ("response", "output", "completion")
COMPLETION_TEXT_FIELDS = ("response", "text", "content", "completion")
SCORE_FIELDS = ("score", "rating")

# Source tag of a pair whose rows name no source.
DEFAULT_PAIR_SOURCE = "score_pairwise"

# Metrics compared between runs, in report order.
SUMMARY_METRICS = (
    "mean_reward",
    "mean_correctness_reward",
    "mean_rlaif_reward",
    "mean_format_reward",
    "tokens_per_sec",
    "samples_per_sec",
    "peak_memory_gb",
    "elapsed_sec",
)
CURVE_METRICS = ("mean_reward", "tokens_per_sec", "samples_per_sec", "peak_memory_gb")

# Row cap of an evaluation run and absolute/relative tolerance of number matching.
EVAL_MAX_SAMPLES = 200
MATCH_TOLERANCE = 1e-6
