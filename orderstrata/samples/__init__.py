"""The operators over the star-schema sample tables, each paired with SQL that checks it."""
