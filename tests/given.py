"""Where the driver's tables lie."""

SF_SMALL = "/root/testdata/sf0.001"
