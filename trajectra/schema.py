"""Schemas of trajectories: messages with tool calls, tools, and the record around them."""

CALL = "struct<id:string,type:string,function:struct<name:string,arguments:string>>"
MESSAGE = f"struct<role:string,name:string,content:string,reasoning_content:string,tool_calls:array<{CALL}>,weight:double,tool_call_id:string>"
TOOL = "struct<type:string,function:struct<name:string,description:string,parameters:string>>"
SCORE = (
    "struct<scaffold:string,assistant_turns:bigint,total_tool_calls:bigint,oec_score:double,iac_score:double,dpi_score:double,ped_score:double,psn_score:double,"
    "tte_score:double,scp_score:double,sub_score:double,fec_score:double,stp_score:double,tvr_score:double,composite_score:double,reproduce_first:double>"
)
#: A working record; content is text, tool parameters and call arguments are JSON text.
TRAJECTORY = f"rec_id string, rec_pos bigint, _instance_id string, _agent_type string, tools array<{TOOL}>, messages array<{MESSAGE}>"
VERSION = "2.0.0"
