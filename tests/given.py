"""Where the smallest given tables are; in a module of its own name, since every test folder has a conftest."""

SMALL = "/root/testdata/sf0.001"
