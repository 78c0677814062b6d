"""Training-data pipeline operators (dedup, language ID, archives, quality
rules, tokenisation, mixing, sharding).  Nothing else in the library imports
this subpackage."""
