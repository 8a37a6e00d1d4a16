"""Where the given tables are. A module of its own: several conftest modules would hide one another."""

SMALL = "/root/testdata/sf0.001"
