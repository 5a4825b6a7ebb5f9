"""Attack patterns. Fixed values, matched anywhere in the text and without regard to case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SQL_INJECTION = (
    r"('|%27).*?(OR|AND|UNION|SELECT|DROP|INSERT|UPDATE|DELETE)",
    r"(;|%3B).*(DROP|DELETE|UPDATE|INSERT)",
    r"UNION\s+(ALL\s+)?SELECT",
    r"1\s*=\s*1",
    r"'.*?'.*?=.*?'.*?'",
)
XSS = (
    r"<\s*script[^>]*>",
    r"javascript\s*:",
    r"on(load|error|click|mouseover)\s*=",
    r"<\s*img[^>]+onerror",
    r"alert\s*\(",
)
PATH_TRAVERSAL = (
    r"\.\./",
    r"\.\.\\",
    r"%2e%2e[/\\%]",
    r"etc/(passwd|shadow|hosts)",
    r"windows/(system32|win\.ini)",
)
# Plain words.
ATTACK_TOOLS = ("sqlmap", "nmap", "nikto", "masscan", "dirbuster", "gobuster", "curl/")
#: Plain substrings, case-sensitive.
SUSPICIOUS_PATH_PARTS = (
    "..", "%2e", "%2E", "etc", "passwd", "shadow", "config", ".git", ".env", "backup",
)

#: Ours: shell metacharacter followed by a command, or command substitution.
COMMAND_INJECTION = (
    r"(;|%3b|\||%7c|&&|%26%26)\s*(cat|ls|id|wget|curl|nc|bash|sh|ping|whoami|rm)\b",
    r"\$\(",
    r"`",
)


def names_any(text: Column, words) -> Column:
    """Any of some plain words, without regard to case; much cheaper than a regex."""
    lowered = F.lower(text)
    found = F.lit(False)
    for word in words:
        found = found | F.contains(lowered, F.lit(word))
    return found


def matches_any(text: Column, patterns) -> Column:
    """One alternation: the engine stops at the first pattern that matches."""
    return F.rlike(text, F.lit("(?i)" + "|".join(f"(?:{p})" for p in patterns)))


def first_match(text: Column, patterns) -> Column:
    """0-based index of the first matching pattern, NULL if none matches."""
    found = F.lit(None).cast("int")
    for i in reversed(range(len(patterns))):
        found = F.when(F.rlike(text, F.lit("(?i)" + patterns[i])), F.lit(i)).otherwise(found)
    return found
