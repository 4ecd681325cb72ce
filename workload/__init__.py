"""The library's queries over the star-schema test tables, with SQL to compare them to."""
