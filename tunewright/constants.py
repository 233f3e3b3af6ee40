"""They decide results and must stay exactly as they are."""

from __future__ import annotations

# ---- fixed values: required keys and defaults of an interview record ----
REQUIRED_FIELDS = ["category", "question", "example_answer", "evaluation_criteria", "correctness"]
DEFAULT_CORRECTNESS = "Model should check correctness, clarity, and concision."
ENTRY_VALID = "Entry {entry}: All required fields are present."
ENTRY_MISSING = "Entry {entry} is missing fields: {missing}"
RUBRIC = [("Correctness", 0.6), ("Clarity", 0.25), ("Conciseness", 0.15)]

# ---- fixed values: texts made of a record's fields ----
RECORD_PROMPT = "{category} Question: {question}\nAnswer:"
RECORD_COMPLETION = " {answer}\nEvaluation: {correctness}"
SFT_PAIR = "{prompt}\n\n{response}"
SFT_PROMPT_PART = "Instruction: {prompt}\n\n"
SFT_CONTEXT_PART = "Context: {context}\n\n"
SFT_RESPONSE_PART = "Response: {response}"
LIST_PREVIEW = "[{count} items] Keys: {keys}"

# ---- fixed values: name patterns that mark a column's part in a training format ----
PROMPT_PATTERNS = ["prompt", "instruction", "question", "input"]
RESPONSE_PATTERNS = ["response", "completion", "output", "answer"]
CHOSEN_PATTERNS = ["chosen", "preferred", "winner"]
REJECTED_PATTERNS = ["rejected", "dispreferred", "loser"]
NO_METHOD = "None (dataset needs formatting)"

# ---- fixed values: categories and question pools for generated records ----
CATEGORIES = ["HTML", "CSS", "JavaScript", "Node.js", "Express", "React", "MySQL"]
QUESTION_POOL = {
    "HTML": [
        "Explain the difference between semantic and non-semantic HTML elements. Provide examples.",
        "How do you include an external CSS file in HTML? Show the tag and attributes.",
        'What is the purpose of the <meta name="viewport"> tag? Provide an example for responsive design.',
        "Describe how to create an accessible form control with a label linked to an input.",
        "How does the <picture> element improve responsive images? Give an example.",
    ],
    "CSS": [
        "Write a CSS rule to create a fixed header at the top of the page.",
        "How do you create a responsive grid that becomes a single column on small screens?",
        "Explain the difference between margin and padding with examples.",
        "Provide a CSS snippet to create a smooth hover transition on buttons.",
        "How do you use CSS variables (custom properties)? Give an example.",
    ],
    "JavaScript": [
        "Write a function to debounce another function in JavaScript.",
        "Explain event delegation and provide a short example.",
        "How do Promises differ from callbacks? Show a simple promise example.",
        "Write code to deep clone a simple object (no functions) in JavaScript.",
        "Explain the purpose of async/await with a fetch example.",
    ],
    "Node.js": [
        "Write a basic Node.js script to read a file asynchronously and log its contents.",
        "Explain how require() differs from import in Node.js (CommonJS vs ESM).",
        "How do you handle uncaught exceptions in a Node.js process?",
        "Write a short example showing how to use environment variables in Node.js.",
        "Explain streams in Node.js and give an example of piping a readable stream to a writable stream.",
    ],
    "Express": [
        "Create an Express route that accepts POST JSON and returns a 201 status.",
        "How would you structure middleware for logging requests in Express? Provide code.",
        "Explain how to serve static files in Express.",
        "Show how to set up error-handling middleware in Express.",
        "Write an example of route parameter extraction in Express (e.g., /users/:id).",
    ],
    "React": [
        "Write a simple functional component that displays a list of items passed as props.",
        "Explain useState and show an example counter component.",
        "How does useEffect differ when provided with [] vs [dep]? Provide examples.",
        "Describe lifting state up with a short example involving two child components.",
        "How do you memoize a component in React and why would you?",
    ],
    "MySQL": [
        "Write a SQL query to find duplicate emails in a users table.",
        "Explain the difference between INNER JOIN and LEFT JOIN with examples.",
        "How do you create an index on a column and why would you do it?",
        "Write a query to paginate results using LIMIT and OFFSET.",
        "Explain transactions in MySQL and how to use BEGIN/COMMIT/ROLLBACK.",
    ],
}

# ---- fixed values: generated answers ----
ANSWERS = {
    "HTML": "Explanation: {question} Example answer demonstrating correct usage.",
    "CSS": "CSS snippet: /* example CSS */\n{question}",
    "JavaScript": "JS Example: // example implementation for {question}",
    "Node.js": "Node.js Example: // example implementation for {question}",
    "Express": "Express Example: // example implementation for {question}",
    "React": "React Example: // example implementation for {question}",
    "MySQL": "SQL Example: -- example query for {question}",
}
FALLBACK_ANSWER = "Example answer"

# ---- fixed values: topics, texts and size of a corpus top-up ----
TOPICS = ["debugging", "testing", "security practices"]
SYNTHETIC_QUESTION = "[Synthetic] Question {number} for {category}: {topic}"
SYNTHETIC_ANSWER = "[Answer {category}] This is a synthetic answer example for the question posed."
TOP_UP_TARGET = 5000

# ---- fixed values: code templates (problem, solution) and their variations ----
CODE_TEMPLATES = [
    ("Write a Python function to add two numbers", "def add(a, b):\n    return a + b\n"),
    ("Write a Python function to subtract two numbers", "def sub(a, b):\n    return a - b\n"),
    ("Write a Python function to multiply two numbers", "def mul(a, b):\n    return a * b\n"),
    (
        "Write a Python function to divide two numbers (handle division by zero)",
        "def safe_div(a, b):\n    return a / b if b != 0 else None\n",
    ),
    ("Write a Python function that reverses a string", "def rev(s):\n    return s[::-1]\n"),
    (
        "Write a Python function to check if a string is a palindrome",
        "def is_palindrome(s):\n    s = ''.join(c.lower() for c in s if c.isalnum())\n    return s == s[::-1]\n",
    ),
    (
        "Write a Python function to compute factorial (iterative)",
        "def factorial(n):\n    result = 1\n    for i in range(2, n+1):\n        result *= i\n    return result\n",
    ),
    (
        "Write a Python function to compute the n-th fibonacci number (iterative)",
        "def fib(n):\n    a, b = 0, 1\n    for _ in range(n):\n        a, b = b, a + b\n    return a\n",
    ),
    (
        "Write a Python function to find the maximum in a list",
        "def max_in_list(lst):\n    return max(lst)\n",
    ),
    (
        "Write a Python function that removes duplicates while preserving order",
        "def unique(seq):\n    seen = set()\n    out = []\n    for x in seq:\n        if x not in seen:\n"
        "            seen.add(x)\n            out.append(x)\n    return out\n",
    ),
]
CODE_PROMPT = "### Problem: {problem} (example {number})\n### Solution:\n"
UNTYPED_SIGNATURE = "(a, b):"
TYPED_SIGNATURE = "(a: int, b: int) -> int:"
DOCSTRING_LINE = '"""Simple implementation"""\n'
BATCH_TARGET = 500
BATCH_SIZE = 100

# ---- fixed values: chat markers ----
TURN = "<|im_start|>{role}\n{content}"
TURN_END = "<|im_end|>\n"
CONVERSATION_COLUMNS = ["messages", "conversations", "conversation"]
ROLE_NAMES = {"human": "user", "gpt": "assistant", "system": "system"}

# ---- fixed values: tokens ----
MAX_LENGTH = 256
IGNORE_LABEL = -100

# ---- fixed values: hardware (flavor, USD per hour, relative time, memory in GB) ----
HARDWARE = [
    ("t4-small", 0.75, 2.0, 16),
    ("t4-medium", 1.50, 1.5, 16),
    ("l4x1", 2.50, 1.2, 24),
    ("l4x4", None, None, 96),
    ("a10g-small", 3.50, 1.3, 24),
    ("a10g-large", 5.00, 1.0, 24),
    ("a10g-largex2", 10.00, 0.6, 48),
    ("a10g-largex4", 20.00, 0.4, 96),
    ("a100-large", 10.00, 0.7, 40),
]
LARGE_MODEL_FLAVORS = ["a10g-largex2", "a10g-largex4", "a100-large"]
LARGE_MODEL_PARAMS = 7
LONG_HOURS = 4
TIMEOUT_FACTOR = 1.3
HOURS_PER_1K = 0.1
GB_PER_BILLION = {"full": 20, "adapters": 4}

# ---- fixed values: model sizes looked for in a name, in this order (billions) ----
NAMED_SIZES = [("0.5B", 0.5), ("1.5B", 1.5), ("3B", 3.0), ("7B", 7.0), ("13B", 13.0)]
DEFAULT_SIZE = 1.0

# ---- fixed values: size bands in billions, lower bound included ----
SIZE_BANDS = [
    (0.0, 1.0, "t4-small"),
    (1.0, 3.0, "a10g-small"),
    (3.0, 7.0, "a10g-large"),
    (7.0, 13.0, "a10g-large (LoRA) or a100-large"),
    (13.0, None, "a100-large (LoRA required)"),
]

# ---- fixed values: dataset sizes assumed where none is known ----
KNOWN_DATASET_SIZES = {"trl-lib/Capybara": 16000, "Anthropic/hh-rlhf": 160000}
DEFAULT_DATASET_SIZE = 10000

# ---- fixed values: run checks and monitoring ----
OVERFIT_RATIO = 1.5
LIVE_SECONDS = 1200
TAIL_LINES = 50
MONITOR_TAIL_LINES = 20
CHECKPOINT_PATTERN = r"(?:^|/)checkpoint-(?:[^/]*-)?(\d+)/*$"
NO_PROCESS = "no training process"
NO_CHECKPOINTS = "no checkpoints"
NO_GPU = "nvidia-smi not available"

# ---- fixed values: inference requests ----
MAX_NEW_TOKENS = 64
TEMPERATURE = 0.0
