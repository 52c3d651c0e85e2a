"""Where the smallest test tables lie."""

SF_SMALL = "/root/testdata/sf0.001"
