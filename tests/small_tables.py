"""Where the tests find the smallest given tables (a module of its own: every test folder has a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
