SF01 = "/root/testdata/sf0.01"
CHECK = "/root/testdata/check_s"
