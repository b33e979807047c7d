"""Column functions: cleaning, tokens, syllables, readability. No function here shuffles or leaves the JVM."""
