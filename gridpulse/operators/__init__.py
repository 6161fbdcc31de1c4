"""DataFrame -> DataFrame steps that work on tables and on streams alike."""
