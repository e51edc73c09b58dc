"""Named queries over the test tables, each with the SQL another engine can check it by."""
