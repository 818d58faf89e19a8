"""Fixed values.

Everything in this module is a constant whose value must equal the one used
by the analysed patch-review tool for results to match: keyword lists,
regex patterns, address sets, code templates, thresholds and move limits.
They are stated plainly and in their natural order.
"""

from __future__ import annotations

# --- fixed values: keyword filter for scheduling subjects (15 regex parts) ---
SCHEDULING_KEYWORDS = [
    "sched", "scheduler", "scheduling", "cfs", "deadline", "rt",
    "load.balance", "migration", "runqueue", "rq", "task.group",
    "cgroup", "numa", "preempt", "fair",
]

# --- fixed values: SQL-side subject filter of the generator loader ---
GENERATOR_SUBJECT_REGEXP = "sched|scheduler|mm|memory|lock|mutex|atomic|fs|net"
GENERATOR_MIN_SUBJECT_BYTES = 10

# --- fixed values: eight case-insensitive subject flags (name, regex) ---
SUBJECT_FLAGS = [
    ("has_fix", "fix|bug|error"),
    ("has_performance", "performance|optimize|improve"),
    ("has_latency", "latency|delay|response"),
    ("has_numa", "numa|node"),
    ("has_realtime", "rt|real.?time|deadline"),
    ("has_cfs", "cfs|fair"),
    ("has_load_balance", "load.?balanc|migration"),
    ("has_runqueue", "runqueue|rq"),
]

# --- fixed values: scheduler maintainer addresses ---
SCHEDULER_MAINTAINERS = [
    "mingo@kernel.org", "peterz@infradead.org", "tglx@linutronix.de",
    "rostedt@goodmis.org", "bristot@kernel.org",
]

# --- fixed values: maintainer domains for author_is_maintainer ---
MAINTAINER_DOMAINS = ["kernel.org", "linux.org", "redhat.com", "intel.com"]

FREQUENT_AUTHOR_MIN = 10
BUSINESS_HOURS = (9, 17)
WEEKEND_DAYS = (5, 6)  # Monday = 0

# --- fixed values: subsystem keyword sets, in priority order ---
SUBSYSTEM_KEYWORDS = [
    ("scheduler", ["sched", "fair", "rt", "rq", "task_struct", "preempt", "numa"]),
    ("memory", ["mm", "memory", "slab", "kmalloc", "page", "alloc", "gfp", "leak"]),
    ("locking", ["lock", "mutex", "spin", "atomic", "rcu", "deadlock", "race"]),
    ("filesystem", ["fs", "file", "inode", "vfs", "mount", "read", "write"]),
    ("network", ["net", "socket", "tcp", "packet", "route", "proto"]),
]
SUBSYSTEMS = [name for name, _ in SUBSYSTEM_KEYWORDS]
DEFAULT_SUBSYSTEM = "scheduler"

# --- fixed values: per-subsystem target defaults
# (primary_variable, function, condition, action, file_path) ---
TARGET_DEFAULTS = [
    ("scheduler", "rq", "schedule", "!rq", "return", "kernel/sched/core.c"),
    ("memory", "ptr", "kmalloc", "!ptr", "return NULL", "mm/slab.c"),
    ("locking", "lock", "spin_lock", "!lock", "return -EINVAL", "kernel/locking/spinlock.c"),
]

# --- fixed values: complexity rule words and word-count limits ---
SIMPLE_WORDS = ["fix", "bug"]
COMPLEX_WORDS = ["optimize", "improve"]
SIMPLE_MAX_WORDS = 8
COMPLEX_MIN_WORDS_EXCLUSIVE = 12
COMPLEXITIES = ["simple", "medium", "complex"]

# --- fixed values: template configuration per subsystem
# (subsystem, path, type, init, secondary_decl, ret_val, lock_acquire, lock_release) ---
TEMPLATE_CONFIG = [
    ("scheduler", "kernel/sched/core.c", "struct rq", " = this_rq()",
     "struct task_struct *curr = rq->curr;", "",
     "raw_spin_lock_irqsave(&rq->lock, flags);",
     "raw_spin_unlock_irqrestore(&rq->lock, flags);"),
    ("memory", "mm/slab.c", "void", "", "struct zone *zone;", " ptr", "", ""),
    ("locking", "kernel/locking/spinlock.c", "spinlock_t", "",
     "struct task_struct *owner;", "", "preempt_disable();", "preempt_enable();"),
]

# --- fixed values: additional logic per (subsystem, complexity) ---
ADDITIONAL_LOGIC = [
    ("scheduler", "medium", "update_rq_clock(rq);"),
    ("scheduler", "complex", "update_rq_clock(rq);\n    if (rq->nr_running > 1) set_tsk_need_resched(curr);"),
    ("memory", "medium", "memset(ptr, 0, size);"),
    ("memory", "complex", "if (gfp & __GFP_ZERO) memset(ptr, 0, size);"),
    ("locking", "medium", "lockdep_assert_held(&lock->rlock);"),
    ("locking", "complex", "lockdep_assert_held(&lock->rlock);\n    if (lock->owner != current) lock->owner = current;"),
]

# --- fixed values: patch templates (braces already unescaped) ---
TEMPLATES = {
    "simple": """--- a/{path}
+++ b/{path}
@@ -123,6 +123,10 @@ {function_signature}(void)
{
    {type} *{primary_var}{init};

    /* Fix: {description} */
    if (unlikely({condition})) {
        {action};
    }

    return{ret_val};
}""",
    "medium": """--- a/{path}
+++ b/{path}
@@ -123,8 +123,15 @@ {function_signature}(void)
{
    {type} *{primary_var}{init};
    {secondary_decl}

    /* Fix: {description} */
    if (unlikely({condition})) {
        goto out;
    }

    {additional_logic}

out:
    {action};
    return{ret_val};
}""",
    "complex": """--- a/{path}
+++ b/{path}
@@ -123,12 +123,25 @@ {function_signature}(void)
{
    {type} *{primary_var}{init};
    {secondary_decl}
    unsigned long flags;

    /* Fix: {description} */
    {lock_acquire}

    if (unlikely({condition})) {
        {action};
        goto unlock;
    }

    {additional_logic}

unlock:
    {lock_release}
    return{ret_val};
}""",
}
DESCRIPTION_MAX_CHARS = 60

# --- fixed values: quality scorer ---
QUALITY_WORDS = ["struct", "rq", "unlikely", "return", "task_struct"]
QUALITY_THRESHOLD = 60
CONFIDENCE_THRESHOLD = 0.5

# --- fixed values: evaluation prompts (20 base issues, 10 modifiers) ---
BASE_ISSUES = [
    "CFS scheduler shows high latency during context switches",
    "Memory leak detected in NUMA allocator",
    "Spinlock contention in interrupt handling path",
    "Real-time scheduler misses deadlines under heavy load",
    "Page allocator fragmentation under pressure",
    "Mutex deadlock detected under stress testing",
    "Load balancing fails with NUMA topology",
    "OOM killer triggers too aggressively",
    "RCU grace periods too long affecting latency",
    "Context switch overhead too high in fair scheduler",
    "RT scheduler priority inversion detected",
    "Idle balancing causes performance regression",
    "Task migration overhead impacts latency",
    "Scheduler tick causes jitter in RT tasks",
    "NUMA balancing causes performance issues",
    "Memory compaction blocks critical paths",
    "Slab allocator shows poor scalability",
    "Memory pressure handling needs improvement",
    "Page reclaim causes latency spikes",
    "NUMA node imbalance affects allocation",
]
MODIFIERS = [
    "",
    " with high CPU utilization",
    " under memory pressure",
    " during stress testing",
    " on NUMA systems",
    " with mixed workloads",
    " in virtualized environments",
    " under I/O pressure",
    " with real-time constraints",
    " during system startup",
]
DEFAULT_AUTHOR_EMAIL = "user@example.com"

# --- fixed values: feature weighting ("attention") ---
ATTENTION_MIX = (0.3, 0.4, 0.3)  # variance, correlation, mutual information
ATTENTION_APPLY = (0.9, 0.1)
EPS = 1e-8

# --- fixed values: improvement loop ---
STRATEGIES = [
    "add_estimators", "tune_learning_rate", "adjust_depth",
    "feature_selection", "ensemble_weights", "regularization_tuning",
]
ACCEPT_MIN_GAIN = 0.0001
STOP_F1 = 0.55
MAX_ESTIMATORS = 300
ESTIMATOR_STEP = 25
MAX_LEARNING_RATE = 0.3
LEARNING_RATE_FACTOR = 1.2
MAX_DEPTH = 12
SELECT_K = 25

# Binding of the subsystem keywords to the test documents: fragments of their
# languages and marks, in the role of the tool's own keywords (which the
# prompts keep), so that every class occurs.
DOCUMENT_KEYWORDS = [
    ("scheduler", [" the ", " with ", " that ", " from "]),
    ("memory", [" der ", " und ", " nicht "]),
    ("locking", [" le ", " que ", " pour ", " dans "]),
    ("filesystem", [" los ", " una ", " del ", " con "]),
    ("network", ["@", "|", "%%%", "http"]),
]

# --- fixed values: English stop words of the TF-IDF tokenizer (the public
# StopWordsRemover English list), the same list in Spark and in the oracle ---
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
