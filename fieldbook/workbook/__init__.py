"""The registered queries and their SQL counterparts over the star-schema tables."""
